"""The words of many texts at once, as a tokenizer with word ends splits them: normalised, cut, and numbered."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Latin letters, punctuation and the like: normalisation changes none but to lower case, and all versions of Unicode class them alike. Left out are
#: four separators that Arrow counts as white space, and the one letter whose lower case is two.
USUAL = re.compile("[\x00-\x1b\x20-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e\u20ac]*")
#: Contractions that are split off, single numbers, runs of anything but letters, numbers and white space; what is left are runs of letters.
SPLIT_OFF = r"('s|'t|'re|'ve|'m|'ll|'d|\pN|[^\s\x0b\x{85}\x{a0}\pL\pN]+)"
#: What stands before a special token, and before a word that is given in the symbols of its bytes.
SPECIAL, SYMBOLS = "\n", "\t"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable, else the next free one."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Splitter:
    """Texts of usual characters are split by Arrow, others by the library's normalizer and splitter."""

    def __init__(self, path: str):
        import regex

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t.content: number for number, t in self.tokenizer.get_added_tokens_decoder().items()}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else re.compile("((?!))")
        self.space = regex.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
        self.symbols = dict(enumerate(byte_symbols()))

    def _unusual(self, text: str) -> list[str]:
        words = []
        for part in self.cut.split(text):
            if part in self.special:
                words.append(SPECIAL + part)
                continue
            for chunk in filter(None, self.space.split(part)):
                plain = self.tokenizer.normalizer.normalize_str(chunk)
                words += [SYMBOLS + word for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
        return words

    def in_symbols(self, word: str) -> str:
        """A word, as `split` gives it, in the symbols of its bytes."""
        if word[0] == SYMBOLS:
            return word[1:]
        return word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.symbols)

    def split(self, texts: pa.Array) -> tuple[list[str], np.ndarray, list[int]]:
        """The different words of all texts, the number of each word in order, and where in that each text begins, with the end of the last. Null
        counts as empty. The empty word means nothing."""
        strings = [t or "" for t in texts.to_pylist()]
        usual = [USUAL.fullmatch(t) is not None and "<|" not in t for t in strings]
        plain = pa.array([t if u else "" for t, u in zip(strings, usual)], pa.string())
        spaced = pc.replace_substring_regex(pc.utf8_lower(plain), SPLIT_OFF, r" \1 ")
        # After white space Arrow's splitter looks at the next byte, which for the last text is behind the column, and gives up where that is odd.
        cut = pc.utf8_split_whitespace(pc.utf8_rtrim_whitespace(spaced))
        coded = cut.values.dictionary_encode()
        words, which, bounds = coded.dictionary.to_pylist(), coded.indices.to_numpy(), cut.offsets.to_pylist()
        if not all(usual):
            number = {word: i for i, word in enumerate(words)}
            parts = []
            for row, text in enumerate(strings):
                if usual[row]:
                    parts.append(which[bounds[row] : bounds[row + 1]])
                else:
                    parts.append(np.array([number.setdefault(word, len(number)) for word in self._unusual(text)], which.dtype))
            words, which = list(number), np.concatenate(parts)
            bounds = [0, *np.cumsum([len(p) for p in parts]).tolist()]
        return words, which, bounds


def look_up(memory: dict, words: list[str], learn, remembered: int) -> list:
    """What is known of different words; `learn` adds those that are missing. Where there is no room the older half goes."""
    missing = [word for word in words if word not in memory]
    if len(memory) + len(missing) > remembered:
        for key in list(memory)[: len(memory) // 2]:
            del memory[key]
        missing = [word for word in words if word not in memory]
    if missing:
        learn(missing)
    return list(map(memory.__getitem__, words))


def shares(column: pa.Array, size: int = 4_000_000) -> list[tuple[int, int]]:
    """Cuts of a text column, of about so many bytes each."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // size)) + 1).tolist(), len(sizes)]
    return [(low, high) for low, high in zip(edges, edges[1:]) if high > low]
