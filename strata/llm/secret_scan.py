"""Secret scanning: an Aho-Corasick automaton finds keywords, anchored regular expressions are tried only at its hits,
and tokens that embed a checksum are kept only if it is right.

A match can begin only at a keyword, so trying the hits in order and going on behind each match gives the leftmost
non-overlapping matches of a scan. Runs of hex digits have no keyword to begin with; one pattern looks for them in the whole
text. Texts are scanned as UTF-8 bytes, and offsets are turned into code points for texts with hits only.

Defined cases: null and empty texts have no secrets; a row is scanned by itself, whatever its key; very long texts are
scanned whole.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import as_bytes, free_name, record_batch

#: Kinds in the order in which spans with the same start are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE = KINDS[:3]
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

#: Keywords and patterns of secrets.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign",
    "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm",
}
ASSIGN = re.compile(rb"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
CHECKED = re.compile(rb"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z_])")
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum(body: bytes) -> bytes:
    """The last six characters of tokens that carry their CRC-32 in base 62."""
    value, digits = zlib.crc32(body), b""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit : digit + 1] + digits
    return digits


def automaton():
    import ahocorasick

    words = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        words.add_word(word, (kind, len(word)))
    words.make_automaton()
    return words


def find_secrets(text: bytes, words) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in bytes, ordered by start and kind."""
    found, done = [], dict.fromkeys(KINDS, 0)
    hits = [(end - n + 1, kind) for end, (kind, n) in words.iter(text.lower().decode("latin-1"))]
    for start, kind in sorted(hits):
        if start < done[kind]:
            continue
        if kind == "assign":
            match = ASSIGN.match(text, start)
            keep = match and len(match[1]) >= ASSIGN_LEAST
        elif kind == "access":
            match = ACCESS.match(text, start)
            keep = match and len(match[0]) >= ACCESS_LEAST
        else:
            match = CHECKED.match(text, start)
            keep = match and checksum(match[1]) == match[2]
        if match:
            done[kind] = match.end()
            if keep:
                found.append((kind, *match.span()))
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def in_code_points(text: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans cover ASCII only, so their lengths stay; starts move by the bytes that go on a character."""
    if text.isascii():
        return spans
    moved, at, points = [], 0, 0
    for kind, start, end in spans:
        points += len(text[at:start].decode())
        at = start
        moved.append((kind, points, points + end - start))
    return moved


def as_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redact(text: bytes, spans: list[tuple[str, int, int]], mark: bytes = b"[secret]") -> bytes:
    """The text with each run of overlapping spans replaced by the mark."""
    parts, at = [], 0
    for _, start, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        elif end <= at:
            continue
        at = max(at, end)
    return b"".join([*parts, text[at:]])


def scan_secrets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per row of docs: key, n_assign, n_access, n_hex, base_sha256, spans (in code points)."""
    counts = [f"n_{kind}" for kind in BASE]
    names = ["key", *counts, "base_sha256", "spans"]
    layout = f"key {docs.schema[key].dataType.simpleString()}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in batches:
            rows = {name: [] for name in names[1:]}
            for content in as_bytes(batch.column("text")):
                spans = in_code_points(content, find_secrets(content, words))
                kinds = [s[0] for s in spans]
                for kind in BASE:
                    rows[f"n_{kind}"].append(kinds.count(kind))
                rows["base_sha256"].append(hashlib.sha256(as_text([s for s in spans if s[0] in BASE]).encode()).hexdigest())
                rows["spans"].append(as_text(spans))
            kinds_of = [batch.column("key").type, *[pa.int64()] * 3, pa.string(), pa.string()]
            yield record_batch({"key": batch.column("key")} | rows, pa.schema(list(zip(names, kinds_of))))

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(scan, layout).withColumnRenamed("key", key)


def without_secrets(docs: DataFrame, text: str, size: str | None = None) -> DataFrame:
    """The same rows with secrets replaced in the text, and column `size` set to its characters where it has changed."""
    mark = free_name(docs, "_changed")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in batches:
            at = batch.schema.get_field_index(text)
            values, changed = [], []
            for content in batch.column(at).cast(pa.binary()).to_pylist():
                spans = find_secrets(content, words) if content else []
                values.append(redact(content, spans) if spans else content)
                changed.append(bool(spans))
            batch = batch.set_column(at, batch.schema.field(at), pa.array(values, pa.binary()).cast(batch.schema.field(at).type))
            yield batch.append_column(mark, pa.array(changed))

    layout = T.StructType([*docs.schema.fields, T.StructField(mark, T.BooleanType())])
    rows = docs.mapInArrow(clean, layout)
    if size is not None:
        rows = rows.withColumn(size, F.when(F.col(mark), F.length(text).cast(docs.schema[size].dataType)).otherwise(F.col(size)))
    return rows.drop(mark)
