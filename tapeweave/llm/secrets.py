"""Secret scans: an Aho-Corasick prefilter, anchored expressions at its hits, checksum validation."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .shared import small_batches

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "checked", "jwt", "key")

_ASSIGN = re.compile("(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{24,}")
_CHECKED = re.compile("(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_JWT = re.compile("(eyJ[A-Za-z0-9_-]+)\\.(eyJ[A-Za-z0-9_-]+)\\.[A-Za-z0-9_-]+")
_KEY = re.compile("-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\\s]+-----END (?:[A-Z]+ )?PRIVATE KEY-----")
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

#: Keywords as they stand in the text lower-cased, and the kind they announce.
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign", "akia": "access", "ghp_": "checked", "gho_": "checked", "ghu_": "checked", "ghs_": "checked", "ghr_": "checked", "npm_": "checked", "eyj": "jwt", "-----begin ": "key"}


def checksum_ok(body: str, check: str) -> bool:
    """Whether check is the CRC-32 of body in base 62, as access tokens of some hosts embed it."""
    value = zlib.crc32(body.encode())
    digits = ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = _DIGITS[d] + digits
    return digits == check


def _is_json(part: str) -> bool:
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))), dict)
    except (ValueError, binascii.Error, RecursionError):
        return False


#: By kind: its expression, and what a match must fulfil.
CHECKS = {
    "assign": (_ASSIGN, lambda m: len(m[2]) >= 6),
    "access": (_ACCESS, lambda m: len(m[0]) >= 20),
    "checked": (_CHECKED, lambda m: checksum_ok(m[1], m[2])),
    "jwt": (_JWT, lambda m: _is_json(m[1]) and _is_json(m[2])),
    "key": (_KEY, lambda m: True),
}


def automaton():
    import ahocorasick

    out = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        out.add_word(word, (len(word), kind))
    out.make_automaton()
    return out


def find_secrets(text: str, machine) -> list[tuple[int, str, int]]:
    """(start, kind, end) of a text's secrets, by start, then kind; places are code points.

    A match of a kind can only start where one of its keywords does, so trying its expression at
    those places from the left, past the last match's end, finds what a search of the whole text
    finds. Runs of hex digits have no keyword; their own expression scans for them.
    """
    spans = [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    hits: dict[str, set[int]] = {}
    for end, (n, kind) in machine.iter(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")):
        hits.setdefault(kind, set()).add(end - n + 1)
    for kind, starts in hits.items():
        expression, fulfils = CHECKS[kind]
        past = 0
        for start in sorted(starts):
            if start >= past and (m := expression.match(text, start)):
                past = m.end()
                if fulfils(m):
                    spans.append((start, kind, past))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def secret_scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_assign, n_access, n_hex, base_sha256, spans.

    spans lists kind:start:end of all secrets by start, then kind; base_sha256 is the digest of the
    same list without the method's own kinds (checked tokens, signed web tokens, private keys).
    Null and empty texts have no secrets; rows with null or repeated ids are rows like others. An empty table
    gives an empty one. Texts of any length are searched whole. Other columns are not read, whatever their names.
    A narrow map over rows: nothing is shuffled, and a lost task is run again.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = automaton()
        for frame in frames:
            rows = []
            for text in frame["_text"]:
                spans = find_secrets(text, machine) if text else []
                base = [s for s in spans if s[1] in KINDS[:3]]
                shown = lambda some: ",".join(f"{kind}:{start}:{end}" for start, kind, end in some)
                rows.append((*[sum(s[1] == kind for s in base) for kind in KINDS[:3]], hashlib.sha256(shown(base).encode()).hexdigest(), shown(spans)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])
            out.insert(0, id_col, frame["_id"].to_numpy())
            yield out

    # ids go as strings: pandas would turn longs with nulls into floats
    narrow = docs.selectExpr(f"cast(`{id_col}` as string) as _id", f"`{text_col}` as _text")
    found = narrow.mapInPandas(run, f"`{id_col}` string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return found.withColumn(id_col, found[id_col].cast(id_type))
