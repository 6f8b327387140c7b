"""Token counts with overlap resynchronisation.

A huge text is encoded in overlapping chunks with offsets. Two neighbours are spliced at a position inside their overlap
where both have a token boundary and which is stable: a space or line end that follows a letter or digit. There every
split before the merges ends, whatever stands further left or right: none of the alternatives of the splitting
pattern takes white space after other characters, and no special token holds white space. What is left of the
position is therefore encoded as in the whole text by the left chunk, what is right of it by the right chunk. Where an
overlap holds no such position it is widened, to the end of the text if need be.

Shorter texts are cut at the same kind of position into pieces of about a word, and a piece is encoded once per
task. Counts of both ways are those of the whole text.

Defined cases: null and empty texts have no tokens; very long texts without white space are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import record_batch

#: A space that certainly begins a split: the character before it is no white space in any reading.
PIECE = re.compile(r"(?<=\S) ")
UNSURE = re.compile(r"\s ")
STABLE = re.compile(r"(?<=[A-Za-z0-9])[ \n]")


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Counter:
    """Counts tokens with one tokenizer; `widened` counts how often an overlap was too small."""

    def __init__(self, tokenizer, chunk: int = 32768, overlap: int = 512, remembered: int = 400_000):
        if not 0 < overlap < chunk:
            raise ValueError("overlap must be positive and smaller than chunk")
        self.tokenizer, self.chunk, self.overlap, self.remembered = tokenizer, chunk, overlap, remembered
        self.known: dict[str, int] = {}
        self.widened = 0

    def count(self, text: str) -> int:
        return self.by_chunks(text) if len(text) > self.chunk else self.by_pieces(text)

    def by_pieces(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = PIECE.split(text) if UNSURE.search(text) else text.split(" ")
        if first == "" and rest:
            first, rest = " " + rest[0], rest[1:]
        missing = set(rest).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > self.remembered:
                self.known.clear()
                missing = set(rest)
            new = list(missing)
            encoded = self.tokenizer.encode_batch_fast([" " + piece for piece in new], add_special_tokens=False)
            self.known.update(zip(new, map(len, encoded)))
        return len(self.tokenizer.encode(first, add_special_tokens=False)) + sum(map(self.known.__getitem__, rest))

    def _starts(self, text: str, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the tokens of text[begin:end], as positions in text."""
        encoded = self.tokenizer.encode(text[begin:end], add_special_tokens=False)
        offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2) + begin
        return offsets[:, 0], offsets[:, 1]

    def _common(self, text: str, left, right, begin: int, end: int) -> int | None:
        """The last stable position in text[begin:end] at which tokens begin in both encodings."""
        for at in reversed([m.start() for m in STABLE.finditer(text, begin, end)]):
            sides = [(at in starts[np.searchsorted(starts, at) :][:1]) and not np.any(ends[starts < at][-4:] > at) for starts, ends in (left, right)]
            if all(sides):
                return at
        return None

    def by_chunks(self, text: str) -> int:
        total, begin, spliced = 0, 0, 0
        end = min(self.chunk, len(text))
        left = self._starts(text, begin, end)
        while end < len(text):
            overlap = self.overlap
            begin = end - overlap
            after = min(begin + self.chunk, len(text))
            right = self._starts(text, begin, after)
            at = self._common(text, left, right, max(begin + 1, spliced), end)
            while at is None and end < len(text):
                self.widened += 1
                overlap *= 2
                end = min(end + overlap, len(text))
                left = self._starts(text, spliced, end)
                if end == len(text):
                    break
                after = max(after, min(end + self.chunk, len(text)))
                right = self._starts(text, begin, after)
                at = self._common(text, left, right, max(begin + 1, spliced), end)
            if at is None:
                break
            total += int(np.count_nonzero((left[0] >= spliced) & (left[0] < at)))
            spliced, left, end = at, right, after
        return total + int(np.count_nonzero(left[0] >= spliced))


def token_counts(docs: DataFrame, key: str, text: str, path: str, chunk: int = 32768, overlap: int = 512) -> DataFrame:
    """One row per row of docs: key, n_bytes, n_tokens. `path` names the tokenizer's file, at the same place on all
    executors. Characters per chunk and overlap bound what is encoded at once."""
    layout = f"key {docs.schema[key].dataType.simpleString()}, n_bytes bigint, n_tokens bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(load(path), chunk, overlap)
            texts = [t or "" for t in batch.column("text").to_pylist()]
            schema = pa.schema([("key", batch.column("key").type), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])
            sizes = batch.column("n_bytes")
            yield record_batch({"key": batch.column("key"), "n_bytes": sizes, "n_tokens": [counter.count(t) for t in texts]}, schema)

    n_bytes = F.octet_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("bigint")
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), n_bytes.alias("n_bytes"))
    return rows.mapInArrow(count, layout).withColumnRenamed("key", key)
