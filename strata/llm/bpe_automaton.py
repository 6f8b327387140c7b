"""BPE as a tokenization automaton.

The automaton reads tokens. It begins with one state that has an arc for every base symbol. Merges are then applied in their
order, each as a gadget: wherever an arc `left` leads to a state with an arc `right`, an arc with the merged token leads
past both, and the state reached by `left` is split so that `right` can no longer follow it. The result is
deterministic and accepts exactly the token sequences that the merges produce.

Compiled are the gadgets, as arrays of what each did: the token it made, its halves, and the pair it forbids. The state behind a token begins as the state
behind its right half at that time; it loses an arc where a gadget forbids it, and it gains the arc of a merged token where it had the arc of
the left half at that time. So an arc is known from the order of a few gadgets. The whole transition table would have billions of
arcs; arcs are worked out when words first need them, for many pairs at once, and kept in a table. A word is encoded by the one walk whose
labels spell it. Decoding emits the labels of the arcs.

Defined cases: null and empty texts have no tokens; special tokens inside texts are recognised as the library does; very
long words are walked without recursion.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import record_batch, worker_memory
from strata.llm.word_split import SPECIAL, Splitter, look_up, shares

#: Stands for the end of a word; no byte symbol is like it.
END = "\x00"
#: Slots of the table of transitions; a pair that shares another's slot is worked out again.
TABLE = 1 << 21
NOWHERE = -2
NEVER = np.iinfo(np.int32).max


class Automaton:
    """labels: id to token. step(state, token) tells whether a transition exists; a state is named by the token behind
    which it stands."""

    START = -1

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str):
        import ahocorasick

        self.end = end
        self.labels = {number: token for token, number in vocabulary.items()}
        self.n_tokens = max(self.labels, default=0) + 1
        #: The gadgets as arrays. Per token the gadget that made it (0: base symbol) and its halves; pairs, sorted, and the gadget that forbids each.
        self.made = np.zeros(self.n_tokens, np.int32)
        self.left, self.right = np.zeros(self.n_tokens, np.int32), np.zeros(self.n_tokens, np.int32)
        forbidden: dict[int, int] = {}
        for number, (left, right) in enumerate(merges, 1):
            self._add_gadget(number, vocabulary[left], vocabulary[right], vocabulary[left + right], forbidden)
        pairs = np.fromiter(forbidden, np.int64, len(forbidden))
        order = np.argsort(pairs)
        self.pairs = np.append(pairs[order], np.iinfo(np.int64).max)
        self.forbids = np.append(np.fromiter(forbidden.values(), np.int32, len(forbidden))[order], NEVER).astype(np.int32)
        self.last = len(merges) + 1
        #: Finds the arc labels that end at each place of a text; the end of a word is one character, END.
        self.spelling = ahocorasick.Automaton()
        tokens = np.array(sorted(vocabulary.values()), np.int64)
        for token in tokens[self._are_reached(tokens)].tolist():
            label = self.labels[token]
            symbols = label.removesuffix(end) + (END if label.endswith(end) else "")
            self.spelling.add_word(symbols, len(symbols) << 24 | token)
        self.spelling.make_automaton()
        self.table_keys, self.table_answers = np.full(TABLE, -2), np.zeros(TABLE, bool)

    def _add_gadget(self, number: int, left: int, right: int, merged: int, forbidden: dict[int, int]) -> None:
        forbidden.setdefault(left * self.n_tokens + right, number)
        if not self.made[merged]:
            self.made[merged], self.left[merged], self.right[merged] = number, left, right

    def _had_arcs(self, states: np.ndarray, tokens: np.ndarray, now: np.ndarray) -> np.ndarray:
        """Whether the state behind each of `states` had an arc `tokens` just before gadget `now`. All pairs go back through the gadgets together,
        until each has met a gadget that forbids it or is down to base symbols."""
        had = np.zeros(len(states), bool)
        at, states, tokens, now = np.arange(len(states)), states.astype(np.int64), tokens.astype(np.int64), now.astype(np.int64)
        while len(at):
            keys = states * self.n_tokens + tokens
            spots = np.searchsorted(self.pairs, keys)
            stays = ~((self.pairs[spots] == keys) & (self.forbids[spots] < now))
            at, states, tokens, now = at[stays], states[stays], tokens[stays], now[stays]
            older, newer = self.made[states], self.made[tokens]
            base = (older == 0) & (newer == 0)
            had[at[base]] = True
            at, states, tokens, older, newer = at[~base], states[~base], tokens[~base], older[~base], newer[~base]
            # The state was copied from that behind its right half when the state's token was made; or else the arc was added beside that
            # of its left half when the token was made, once the states were split: after a symbol that stayed alone its own double can't follow.
            back = older > newer
            now = np.where(back, older, newer + 1)
            states, tokens = np.where(back, self.right[states], states), np.where(back, tokens, self.left[tokens])
        return had

    def _are_reached(self, tokens: np.ndarray) -> np.ndarray:
        """Whether an arc with each of these tokens was ever added: its halves must have met before its gadget."""
        made = self.made[tokens]
        reached = self._had_arcs(self.left[tokens], self.right[tokens], made)
        single = np.array([len(self.labels[t].removesuffix(self.end)) == 1 for t in tokens.tolist()], bool)
        return np.where(made > 0, reached, single)

    def steps(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """The transitions, by a table that keeps what was worked out for each pair."""
        keys = states.astype(np.int64) * self.n_tokens + tokens
        slots = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(43)).astype(np.int64) % TABLE
        known = (self.table_keys[slots] == keys) | (states == self.START)
        answers = self.table_answers[slots] | (states == self.START)
        if not known.all():
            new, where = np.unique(keys[~known], return_inverse=True)
            worked_out = self._had_arcs(*np.divmod(new, self.n_tokens), np.full(len(new), self.last))
            answers[~known] = worked_out[where]
            self.table_keys[slots[~known]] = keys[~known]
            self.table_answers[slots[~known]] = worked_out[where]
        return answers

    def encode(self, words: list[str]) -> list[list[int]]:
        """Tokens of pre-split words, given by their byte symbols.

        Exactly one walk spells the symbols up to a place, so the states of all words are found place by place: a
        label that ends there is the walk's last if the state where it begins has its arc. The walk is then read
        back from the end of each word.
        """
        if not words:
            return []
        text = END.join([*words, ""])
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths)
        begins = ends - lengths
        found = np.fromiter(itertools.chain.from_iterable(self.spelling.iter(text)), np.int64).reshape(-1, 2)
        stop, token, size = found[:, 0] + 1, found[:, 1] & 0xFFFFFF, found[:, 1] >> 24
        word = np.repeat(np.arange(len(words)), lengths)
        offset = stop - begins[word[stop - 1]]
        order = np.argsort(offset, kind="stable")
        stop, token, size = stop[order], token[order], size[order]
        cuts = np.searchsorted(offset[order], np.arange(1, lengths.max() + 2))
        states = np.full(len(text) + 1, NOWHERE)  # behind the symbols of a word; at its begin the first state
        states[begins] = self.START
        last, back = np.full(len(text) + 1, NOWHERE), np.zeros(len(text) + 1, np.int64)
        for low, high in zip(cuts[:-1], cuts[1:]):
            at, label, length = stop[low:high], token[low:high], size[low:high]
            state = states[at - length]
            open_ = state != NOWHERE
            at, label, length = at[open_], label[open_], length[open_]
            takes = self.steps(state[open_], label)
            at, label, length = at[takes], label[takes], length[takes]
            last[at], back[at] = label, length
            inner = states[at] == NOWHERE
            states[at[inner]] = label[inner]
        if (last[ends] == NOWHERE).any():
            raise ValueError(f"no tokens for {words[int(np.argmax(last[ends] == NOWHERE))]!r}")
        on_walk, place, own = np.zeros(len(text) + 1, bool), ends, begins
        while len(place):
            on_walk[place] = True
            place = place - back[place]
            place, own = place[place > own], own[place > own]
        places = np.flatnonzero(on_walk)
        tokens, counts = last[places].tolist(), np.cumsum(np.bincount(word[places - 1], minlength=len(words))).tolist()
        return [tokens[low:high] for low, high in zip([0, *counts], counts)]

    def decode(self, tokens: list[int]) -> str:
        labels = self.labels
        return " ".join([labels[token] for token in tokens])


class Encoder:
    """Encodes whole texts: special tokens, normalisation and splitting as the tokenizer's file says, then the automaton, once for each word that
    is not remembered."""

    def __init__(self, path: str, remembered: int = 250_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.automaton = Automaton(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])
        self.splitter, self.remembered = Splitter(path), remembered
        self.automaton.labels.update({number: token for token, number in self.splitter.special.items()})
        self.names = {token: f" {token}" for token in self.automaton.labels}
        #: Ids and labels of a word, each after a space.
        self.known: dict[str, tuple[str, str]] = {}

    def _learn(self, words: list[str]) -> None:
        plain = [word for word in words if word and word[0] != SPECIAL]
        tokens = dict(zip(plain, self.automaton.encode([self.splitter.in_symbols(word) for word in plain])))
        names, decode = self.names, self.automaton.decode
        for word in words:
            own = tokens.get(word)
            if own is None:
                own = [self.splitter.special[word[1:]]] if word else []
            self.known[word] = "".join([names[token] for token in own]), " " + decode(own) if own else ""

    def encode_batch(self, texts: list[str] | pa.Array) -> list[tuple[str, str, int]]:
        """For each text ids and labels, each joined by spaces, and the number of tokens."""
        words, which, bounds = self.splitter.split(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        own = look_up(self.known, words, self._learn, self.remembered)
        ids, labels, which = [x[0] for x in own], [x[1] for x in own], which.tolist()
        result = []
        for low, high in itertools.pairwise(bounds):
            part = which[low:high]
            text = "".join([ids[i] for i in part])
            result.append((text[1:], "".join([labels[i] for i in part])[1:], text.count(" ")))
        return result

    def in_batches(self, texts: list[str] | pa.Array, size: int = 1_000_000) -> Iterator[tuple[str, str, int]]:
        """The same for any number of texts, of about so many bytes at a time. Arrow gives back what it took for them, as a worker stays with what it once held."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        for low, high in shares(column, size):
            yield from self.encode_batch(column.slice(low, high - low))
            pa.default_memory_pool().release_unused()


def encoded(docs: DataFrame, key: str, text: str, path: str, with_ids: bool = False) -> DataFrame:
    """One row per row of docs: key, n_tokens, ids_sha256 and decoded_sha256, and with `with_ids` the ids and the decoded
    text. `path` names the tokenizer's file, at the same place on all executors."""
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if with_ids:
        fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
    layout = f"key {docs.schema[key].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    layout += ", ids array<int>, decoded string" if with_ids else ""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One automaton and one memory for all tasks of a worker.
        encoder = worker_memory(("bpe_automaton", path, os.path.getsize(path), os.path.getmtime(path)), lambda: Encoder(path))
        for batch in batches:
            rows = {name: [] for name, _ in fields}
            for ids, labels, n in encoder.in_batches(batch.column("text")):
                rows["n_tokens"].append(n)
                rows["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(labels.encode()).hexdigest())
                if with_ids:
                    rows["ids"].append([int(i) for i in ids.split()])
                    rows["decoded"].append(labels)
            yield record_batch({"key": batch.column("key")} | rows, pa.schema([("key", batch.column("key").type), *fields]))

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(encode, layout).withColumnRenamed("key", key)
