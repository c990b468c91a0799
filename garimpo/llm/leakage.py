"""Held-out evaluation items that appear, wholly or in part, in a training corpus.

1. Items are cut into word 3-grams and into word pairs (neighbours, or with one word between them). One that few items share is rare. A rare
   3-gram seeds a candidate, and so do ``pairs`` different rare pairs: text in which every third word was changed has no
   3-gram left. Stock phrases are not rare; an item without a rare 3-gram is seeded by all of its own, so none is left out.
2. The seeds meet every document in one narrow pass (documents are never shuffled). A batch of documents is folded, cut into words
   and hashed as one array (polynomial hashes by prefix sums), and only words at which a seed ends come to Python.
   Items are a stated query set: they are held in memory in blocks of ``block`` words, each block is one more scan.
3. A candidate pair is aligned by Smith-Waterman over words (a word one edit away counts as the word), in up to two stretches in the item's
   order, unless the document has too few of the item's words for any alignment to reach ``least`` (a bound, not a guess). The share
   of the item's words that are matched decides, together with the share of the item's own (rare) words inside the aligned
   stretches, so that stock phrases alone never suffice.

Defined cases: null or empty texts on either side match nothing; items shorter than an n-gram are seeded by their whole text; equal
documents are reported each; very long documents are aligned around their seeds only, which finds every stretch that holds one; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from garimpo.llm.texts import BREAK, fold_bytes, words


@dataclass(frozen=True)
class Leak:
    #: words in a seed
    n: int = 3
    #: items that may share a rare n-gram
    shared: int = 3
    #: share of the item's words that must be matched word by word: half of the wording, less what small alterations cost
    least: float = 0.45
    #: rare word pairs that seed a candidate together
    pairs: int = 3
    #: share of the rare words within the aligned stretches that must be matched
    own: float = 0.4
    #: words a second stretch needs
    stretch: int = 5
    #: words of items held in memory at once
    block: int = 2_000_000


def _less(word: str) -> set[str]:
    """The word and, for longer ones, the strings with one letter left out."""
    return {word} if len(word) < 4 else {word, *(word[:k] + word[k + 1 :] for k in range(len(word)))}


_WORDY = np.zeros(256, bool)
_WORDY[97:123] = _WORDY[48:58] = True
#: odd, so that its powers have inverses modulo 2**64
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word of many texts, as ``words`` of each cuts them. Equal words have equal hashes wherever they stand."""
    data = fold_bytes(texts)
    wordy = _WORDY[data]
    edge = np.diff(np.concatenate([[False], wordy, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # values modulo 2**64: a word's share of the prefix sums, moved to exponent 0
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.where(wordy, data, 0).astype(np.uint64) * _powers(_BASE, len(data)), dtype=np.uint64)])
    hashes = (sums[end] - sums[begin]) * _powers(pow(_BASE, -1, 1 << 64), len(data))[begin]
    return hashes, (np.cumsum(data == ord(BREAK)) if len(data) else data)[begin]


def _gram(codes: list[np.ndarray], kind: int) -> np.ndarray:
    """One number for each n-gram of word codes (-1: not a word of any item)."""
    out = np.full(len(codes[0]), kind, np.uint64)
    for c in codes:
        out = (out ^ (c.astype(np.uint64) + np.uint64(1))) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


class Lookup:
    """key -> rows of a sorted table of (key, value)."""

    def __init__(self, keys: np.ndarray, values: list):
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.unique, self.first = np.unique(self.keys, return_index=True)
        self.last = np.append(self.first[1:], len(keys))
        self.values = [values[k] for k in order]

    def hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``keys`` that are known, their rows among the unique keys)"""
        if not len(self.unique) or not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.unique, keys), len(self.unique) - 1)
        found = np.flatnonzero(self.unique[at] == keys)
        return found, at[found]


def grams(w: list[str], n: int) -> set[tuple]:
    """n-grams and pairs of an item: words, with None for any word between."""
    whole = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}
    return whole | {(w[k], w[k + 1], 0) for k in range(len(w) - 1)} | {(w[k], w[k + 2], 1) for k in range(len(w) - 2)}


def is_pair(g: tuple) -> bool:
    return isinstance(g[-1], int)


class Items:
    """A block of items, indexed."""

    def __init__(self, items: list[tuple[int, list[str]]], p: Leak, frequency: Counter, word_frequency: Counter):
        self.p = p
        self.near: dict[str, set[str]] = defaultdict(set)
        self.close: dict[str, tuple[int, list[int]]] = {}
        # item -> (its words as numbers of its different words, their codes, places of its rare words)
        self.own: dict[int, tuple[np.ndarray, np.ndarray, list[int]]] = {}
        vocabulary = sorted({x for _, w in items for x in w})
        self.code = code = {x: k for k, x in enumerate(vocabulary)}
        self.number = np.full(len(vocabulary) + 1, -1, np.int32)
        for x in vocabulary:
            for v in _less(x):
                self.near[v].add(x)
        self.codes = Lookup(word_hashes([" ".join(vocabulary)])[0], list(range(len(vocabulary))))
        seeds: dict[tuple, list[int]] = defaultdict(list)
        for item, w in items:
            every = grams(w, p.n)
            chosen = {g for g in every if frequency[g] <= p.shared}
            if not any(not is_pair(g) for g in chosen):
                chosen |= {g for g in every if not is_pair(g)}
            for g in chosen:
                seeds[g].append(item)
            local, ours = np.unique(np.array([code[x] for x in w]), return_inverse=True)
            self.own[item] = (ours.astype(np.int32), local, [k for k, x in enumerate(w) if word_frequency[x] <= p.shared])
        # kind: the number of words, or -1 and -2 for pairs of neighbours and of words with one between
        self.kinds: dict[int, Lookup] = {}
        groups: dict[int, list[tuple[list[int], list[int]]]] = defaultdict(list)
        for g, owners in seeds.items():
            kind, w = (-1 - g[-1], g[:-1]) if is_pair(g) else (len(g), g)
            groups[kind].append(([code[x] for x in w], owners))
        for kind, rows in groups.items():
            columns = [np.array(c, np.int64) for c in zip(*(w for w, _ in rows))]
            self.kinds[kind] = Lookup(_gram(columns, kind % 97), [owners for _, owners in rows])

    def candidates(self, texts: list[str]) -> dict[int, dict[int, list[int]]]:
        """text -> item -> places (words from the text's first) at which seeds of the item end"""
        hashes, owner = word_hashes(texts)
        code = np.full(len(hashes), -1, np.int64)
        at, row = self.codes.hits(hashes)
        code[at] = np.array(self.codes.values, np.int64)[self.codes.first[row]] if len(at) else 0
        begin = np.searchsorted(owner, np.arange(len(texts)))
        out: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        pairs: dict[tuple[int, int], dict[tuple[int, int], list[int]]] = defaultdict(lambda: defaultdict(list))
        for kind, lookup in self.kinds.items():
            offsets = list(range(kind)) if kind > 0 else [0, -kind]
            size = len(code) - offsets[-1]
            if size <= 0:
                continue
            columns = [code[o : o + size] for o in offsets]
            known = owner[:size] == owner[offsets[-1] :]
            for c in columns:
                known &= c >= 0
            start = np.flatnonzero(known)
            found, rows = lookup.hits(_gram([c[start] for c in columns], kind % 97))
            for s, r in zip(start[found].tolist(), rows.tolist()):
                text = int(owner[s])
                place = s + offsets[-1] - int(begin[text])
                for owners in lookup.values[lookup.first[r] : lookup.last[r]]:
                    for item in owners:
                        if kind > 0:
                            out[text][item].append(place)
                        else:
                            pairs[text, item][kind, r].append(place)
        for (text, item), different in pairs.items():
            if len(different) >= self.p.pairs or item in out.get(text, ()):
                out[text][item] += [x for places in different.values() for x in places]
        return out

    def read(self, w: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A document in words of the items: (code of each word or -1, places of words with near ones, codes of those, ascending by place)."""
        if len(self.close) > 500_000:  # words of a corpus have no end
            self.close.clear()
        codes, places, others = [], [], []
        for k, x in enumerate(w):
            if (known := self.close.get(x)) is None:
                near = {y for v in _less(x) for y in self.near.get(v, ()) if y != x and not y.isdigit()} if len(x) > 3 and not x.isdigit() else ()
                known = self.close[x] = (self.code.get(x, -1), sorted(self.code[y] for y in near))
            codes.append(known[0])
            if known[1]:
                places += [k] * len(known[1])
                others += known[1]
        return np.array(codes, np.int32), np.array(places, np.int64), np.array(others, np.int64)

    def faced(self, item: int, doc: tuple[np.ndarray, np.ndarray, np.ndarray], at: list[int]) -> tuple[np.ndarray, np.ndarray, list[int]] | None:
        """(the item's words, the document's words around the seeds in the item's numbers, places of the item's rare words), or None if
        no alignment of them can reach ``least``."""
        codes, places, others = doc
        ours, local, rare = self.own[item]
        number = self.number
        number[local] = np.arange(len(local))
        theirs = number[codes]  # -1 falls on the last place, which is -1
        mine = number[others]
        fits = (mine >= 0) & (theirs[places] < 0)
        theirs[places[fits][::-1]] = mine[fits][::-1]  # of several near words the first
        number[local] = -1
        # around the seeds only, pieces parted by -2
        reach = 2 * len(ours) + 20
        keep: list[tuple[int, int]] = []
        for k in sorted(set(at)):
            a, b = max(0, k - reach), min(len(codes), k + reach)
            if keep and a <= keep[-1][1]:
                keep[-1] = (keep[-1][0], b)
            else:
                keep.append((a, b))
        theirs = np.concatenate([x for a, b in keep for x in (theirs[a:b], np.array([-2], np.int32))])
        present = np.zeros(len(local) + 2, bool)
        present[theirs] = True  # -1 and -2 fall on the two last places
        if present[ours].sum() < self.p.least * len(ours):  # a bound: an alignment matches no word that isn't there
            return None
        return ours, theirs, rare


def covered(faced: list[tuple[np.ndarray, np.ndarray, list[int]]], p: Leak) -> list[tuple[float, float]]:
    """For each pair (share of the item's words matched, share of its rare words matched within the stretches)."""
    out = []
    for (ours, _, rare), (matched, spans) in zip(faced, stretches([f[0] for f in faced], [f[1] for f in faced], p.stretch)):
        inside = [k for k in rare if any(a <= k < b for a, b in spans)]
        out.append((len(matched) / len(ours), sum(k in matched for k in inside) / len(inside) if inside else 1.0 if not rare else 0.0))
    return out


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, list[tuple[int, int]]]:
    """Best local alignment (match 2, else -1): its score and the matched positions."""
    return align_many([a], [b])[0]


def align_many(left: list[np.ndarray], right: list[np.ndarray], cells: int = 4_000_000) -> list[tuple[int, list[tuple[int, int]]]]:
    """``align`` of many pairs, padded side by side: the rows of the recurrence are those of all pairs of a block at once."""
    out: list = [(0, [])] * len(left)
    order = sorted((k for k in range(len(left)) if len(left[k]) and len(right[k])), key=lambda k: (len(right[k]), len(left[k])))
    begin = 0
    while begin < len(order):
        block = [order[begin]]
        tall, wide = len(left[block[0]]), len(right[block[0]])
        for k in order[begin + 1 :]:
            t, w = max(tall, len(left[k])), max(wide, len(right[k]))
            if (t + 1) * (w + 1) * (len(block) + 1) > cells:
                break
            block.append(k)
            tall, wide = t, w
        begin += len(block)
        # what is padded matches nothing, so that no best end lies there
        a, b = np.full((len(block), tall), -8, np.int32), np.full((len(block), wide), -9, np.int32)
        for r, k in enumerate(block):
            a[r, : len(left[k])], b[r, : len(right[k])] = left[k], right[k]
        h = np.zeros((tall + 1, len(block), wide + 1), dtype=np.int32)
        steps = np.arange(wide + 1, dtype=np.int32)
        for i in range(1, tall + 1):
            row, above = h[i], h[i - 1]
            same = b == a[:, i - 1, None]
            np.multiply(same, 3, out=row[:, 1:], dtype=np.int32, casting="unsafe")
            row[:, 1:] += above[:, :-1]
            row[:, 1:] -= 1
            np.maximum(row, above - 1, out=row)
            np.maximum(row, 0, out=row)
            row += steps
            np.maximum.accumulate(row, axis=1, out=row)
            row -= steps
        for r, k in enumerate(block):
            out[k] = _trace(h[: len(left[k]) + 1, r, : len(right[k]) + 1], left[k], right[k])
    return out


def _trace(h: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[int, list[tuple[int, int]]]:
    i, j = map(int, np.unravel_index(int(h.argmax()), h.shape))
    score, out = int(h[i, j]), []
    here = score
    while here > 0:
        same = a[i - 1] == b[j - 1]
        if here == h[i - 1, j - 1] + (2 if same else -1):
            if same:
                out.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif here == h[i - 1, j] - 1:
            i -= 1
        else:
            j -= 1
        here = int(h[i, j])
    return score, out[::-1]


def stretches(left: list[np.ndarray], right: list[np.ndarray], least: int) -> list[tuple[set[int], list[tuple[int, int]]]]:
    """For each pair the matched positions of the left one in its best and a second stretch, in order, and the stretches' extents."""
    firsts = [found for _, found in align_many(left, right)]
    rest_a, rest_b, whose = [], [], []  # what lies before and after the best stretch, where a second one has room
    for k, (a, b, first) in enumerate(zip(left, right, firsts)):
        if first:
            (i0, j0), (i1, j1) = first[0], first[-1]
            for x, y, shift in ((a[:i0], b[:j0], 0), (a[i1 + 1 :], b[j1 + 1 :], i1 + 1)):
                if min(len(x), len(y)) >= least:
                    rest_a.append(x)
                    rest_b.append(y)
                    whose.append((k, shift))
    seconds: dict[int, tuple[int, list[int]]] = {}
    for (k, shift), (score, found) in zip(whose, align_many(rest_a, rest_b)):
        if k not in seconds or score > seconds[k][0]:  # the one before, if both are as good
            seconds[k] = (score, [i + shift for i, _ in found])
    out = []
    for k, first in enumerate(firsts):
        matched, spans = {i for i, _ in first}, [(first[0][0], first[-1][0] + 1)] if first else []
        second = seconds.get(k, (0, []))[1]
        if len(second) >= least:
            matched |= set(second)
            spans.append((second[0], second[-1] + 1))
        out.append((matched, spans))
    return out


def scores(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, p: Leak = Leak()) -> DataFrame:
    """(doc_id, item_id, coberto, proprio) of all aligned pairs."""
    blocks: list[list[tuple[int, list[str]]]] = [[]]
    frequency: Counter = Counter()
    word_frequency: Counter = Counter()
    size = 0
    for item, t in items.select(item_id, item_text).toLocalIterator():  # the stated query set
        w = words(t)
        if item is None or not w:
            continue
        frequency.update(grams(w, p.n))
        word_frequency.update(set(w))
        if size + len(w) > p.block and blocks[-1]:
            blocks.append([])
            size = 0
        blocks[-1].append((item, w))
        size += len(w)
    fields = {f.name: f.dataType.simpleString() for f in [*docs.select(doc_id).schema, *items.select(item_id).schema]}
    schema = f"doc_id {fields[doc_id]}, item_id {fields[item_id]}, coberto double, proprio double"
    spark, out = docs.sparkSession, None
    for block in blocks:
        shared = spark.sparkContext.broadcast((block, {g: c for g, c in frequency.items() if c > p.shared}, {x: c for x, c in word_frequency.items() if c > p.shared}))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Items(shared.value[0], p, Counter(shared.value[1]), Counter(shared.value[2]))
            for batch in batches:
                rows = []
                for k in range(0, batch.num_rows, 256):
                    part = batch.slice(k, 256)
                    ids, texts = part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()]
                    pairs, faced = [], []
                    for text, found in sorted(index.candidates(texts).items()):
                        doc = index.read(words(texts[text]))
                        for item, at in found.items():
                            if (f := index.faced(item, doc, at)) is not None:
                                pairs.append((ids[text], item))
                                faced.append(f)
                    rows += [(*pair, *shares) for pair, shares in zip(pairs, covered(faced, p))]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], ty) for k, ty in enumerate((batch.schema.field(0).type, pa.int64(), pa.float64(), pa.float64()))], names=["doc_id", "item_id", "coberto", "proprio"])

        part = docs.select(doc_id, text).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, p: Leak = Leak()) -> DataFrame:
    return scores(docs, doc_id, text, items, item_id, item_text, p).filter(f"coberto >= {p.least} and proprio >= {p.own}").select("doc_id", "item_id")
