"""Language of documents and of the stretches of mixed ones.

Model: letter n-grams of the folded text (lower case, accents dropped or mended, so that neither their lack nor their ruin matters) and
whole words are hashed to rows of an embedding table; a sentence is the mean of its rows; a linear softmax gives the languages.
Trained in numpy by stochastic gradient descent on a bounded sample of labelled documents (``sample`` per language). Labels are
partly wrong, so training runs twice: for the second round each sentence gets the language that the first model sees in it and its
neighbours, whatever the label says. A temperature is fitted on held-out sentences; a sentence whose calibrated confidence is below ``reject`` (headings, log lines, numbers) has no
language of its own.

Use: every document is cut into sentences and scored on its executor, in numpy over whole Arrow batches (the product of
embedding and softmax weights is taken beforehand, which gives the same scores with one short row per n-gram). Sentences are joined to
stretches by the best path (Viterbi) with a cost for each change, so sentences without a language of their own follow
their neighbours. Nothing is shuffled.

Defined cases: null or blank texts have no language and give no rows; a text without any accepted sentence gets the model's best
guess with its low confidence; ties go to the language that comes first in ``LANGUAGES``; repeated documents are judged
alike; texts are used whole, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from garimpo.functions.text import ACCENTED, PLAIN
from garimpo.llm.texts import BREAK, fold, fold_bytes, mend

LANGUAGES = ("pt", "es", "en", "fr", "it")
# fixed values: ways to write a label
NAMES = {
    "pt": "pt por portugues portuguese portugais portoghese portugues-br",
    "es": "es spa espanol castellano spanish espagnol spagnolo castelhano espanhol",
    "en": "en eng english ingles inglese anglais",
    "fr": "fr fra fre francais french frances francese",
    "it": "it ita italiano italian italien",
}
# fixed values: words that stand for an unknown language
UNKNOWN = {"", "unknown", "und", "n/a", "na", "none", "null", "nan", "?", "-", "xx", "mis", "mul", "zxx", "desconhecido", "other"}
_LABEL = {w: k for k, words in NAMES.items() for w in words.split()}

#: the end of a sentence, or an empty line; the leading set is what makes the search fast
_SENTENCE = re.compile(r"""[.!?…\n](?:(?<=[.!?…])["'”»)\]]*\s+|(?<=\n)\s*\n\s*)""")


_CODE = re.compile(r"[=_\[\]{}<>|#@\\]")


def plain(sentence: str) -> str:
    """The folded letters of a sentence; code and log lines (two or more of their signs) have none."""
    return "" if len(_CODE.findall(sentence)) > 1 else re.sub(r"[^a-z]+", " ", fold(sentence)).strip()


def label(text: str | None) -> str | None:
    """The language a label names, None if it is missing or unknown; an unlisted name is itself."""
    t = fold(text or "").strip()
    if t in UNKNOWN:
        return None
    return _LABEL.get(t) or _LABEL.get(re.split(r"[-_ ]", t)[0]) or t


def sentences(text: str) -> list[tuple[int, int]]:
    """(begin, end) of the sentences, blanks around them left out."""
    out, at = [], 0
    for m in _SENTENCE.finditer(text):
        out.append((at, m.start() + 1))
        at = m.end()
    out.append((at, len(text)))
    trimmed = []
    for a, b in out:
        piece = text[a:b]
        a += len(piece) - len(piece.lstrip())
        b = a + len(piece.strip())
        if b > a:
            trimmed.append((a, b))
    return trimmed


@dataclass(frozen=True)
class Settings:
    #: labelled documents per language to train on
    sample: int = 600
    #: times a sentence counts in training at most
    repeat: int = 8
    buckets: int = 1 << 16
    size: int = 16
    orders: tuple[int, ...] = (3, 4)
    epochs: int = 6
    rate: float = 0.5
    #: sentences in a step
    batch: int = 64
    #: share of sentences held out for the temperature
    held: float = 0.1
    #: calibrated confidence below which a sentence has no language of its own
    reject: float = 0.80
    #: cost of a change of language, in nats
    change: float = 2.0
    seed: int = 11


_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_SIGN = np.zeros(256, bool)
_SIGN[list(b"=_[]{}<>|#@\\")] = True


def prepared(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, piece of each byte) of many sentences, as ``plain`` of each, framed by two blanks: letters and single blanks."""
    data = fold_bytes(pieces)
    ends = data == ord(BREAK)
    owner = np.cumsum(ends) - ends
    letters = _LETTER[data]
    signs = np.bincount(owner[_SIGN[data]], minlength=len(pieces))
    if (signs > 1).any():
        letters &= ~(signs > 1)[owner]
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # the first of a run of other characters
    keep |= ends
    return np.where(letters, data, 32)[keep], owner[keep]


def windows(data: np.ndarray, owner: np.ndarray, p: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order: (rows of the table, piece) of the hashed letter n-grams, pieces ascending."""
    data = np.concatenate([[32], data, [32, 32]]).astype(np.uint32)
    owner = np.concatenate([[0], owner, [0, 0]])
    out, n = [], len(data)
    for order in p.orders:
        h = np.zeros(max(0, n - order + 1), np.uint32)
        for k in range(order):
            h = h * np.uint32(0x01000193) ^ data[k : n - order + 1 + k] * np.uint32(0x9E3779B1)
        at = np.flatnonzero(data[order // 2 : n - order + 1 + order // 2] != 32)
        h = (h[at] ^ (h[at] >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * order)
        out.append(((h >> np.uint32(7)) % np.uint32(p.buckets), owner[at + order // 2]))
    return out


def features(texts: list[str], p: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(rows, begin of each text in rows) of plain texts, for training."""
    both = windows(*prepared(texts), p)
    rows, owner = np.concatenate([r for r, _ in both]), np.concatenate([o for _, o in both])
    order = np.argsort(owner, kind="stable")
    return rows[order].astype(np.int64), np.searchsorted(owner[order], np.arange(len(texts) + 1))


class Model:
    def __init__(self, p: Settings):
        rng = np.random.default_rng(p.seed)
        self.p = p
        self.e = ((rng.random((p.buckets, p.size)) - 0.5) / p.size).astype(np.float32)
        self.w = np.zeros((p.size, len(LANGUAGES)), np.float32)
        self.b = np.zeros(len(LANGUAGES), np.float32)
        self.temperature = 1.0

    @classmethod
    def with_table(cls, p: Settings, b: np.ndarray, temperature: float) -> "Model":
        """A model that only judges by a given table: without weights of its own."""
        m = cls.__new__(cls)
        m.p, m.b, m.temperature = p, b, temperature
        return m

    def train(self, texts: list[str], y: np.ndarray) -> "Model":
        p = self.p
        rng = np.random.default_rng(p.seed)
        rows, begin = features(texts, p)
        weight = len(y) / (len(LANGUAGES) * np.maximum(np.bincount(y, minlength=len(LANGUAGES)), 1))
        steps = p.epochs * ((len(texts) + p.batch - 1) // p.batch)
        step = 0
        for _ in range(p.epochs):
            order = rng.permutation(len(texts))
            for k in range(0, len(order), p.batch):
                rate = p.rate * (1 - step / steps)
                step += 1
                chosen = order[k : k + p.batch]
                chosen = chosen[begin[chosen + 1] > begin[chosen]]
                if not len(chosen):
                    continue
                sizes = begin[chosen + 1] - begin[chosen]
                r = np.concatenate([rows[begin[c] : begin[c + 1]] for c in chosen])
                cuts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                mean = np.add.reduceat(self.e[r], cuts, axis=0) / sizes[:, None]
                g = softmax(mean @ self.w + self.b)
                g[np.arange(len(chosen)), y[chosen]] -= 1
                g *= weight[y[chosen]][:, None] / len(chosen)
                back = (g @ self.w.T).astype(np.float32)
                self.w -= rate * 4 * (mean.T @ g).astype(np.float32)
                self.b -= rate * g.sum(0).astype(np.float32)
                sort = np.argsort(r, kind="stable")
                r, back = r[sort], back[np.repeat(np.arange(len(chosen)), sizes)[sort]]
                first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
                self.e[r[first]] -= (rate * 16) * np.add.reduceat(back, first, axis=0)
        return self

    def table(self) -> np.ndarray:
        return np.ascontiguousarray(self.e @ self.w)

    def logits(self, pieces: list[str], table: np.ndarray | None = None) -> np.ndarray:
        return self.score(pieces, table)[0]

    def score(self, pieces: list[str], table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(logits, whether there is anything to judge by) of sentences as they are written."""
        table = self.table() if table is None else table
        sums, counts = np.zeros((len(pieces), len(LANGUAGES)), np.float32), np.zeros(len(pieces), np.int64)
        if pieces:
            for rows, owner in windows(*prepared(pieces), self.p):
                if len(rows):
                    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                    sums[owner[first]] += np.add.reduceat(table.take(rows, axis=0), first, axis=0)
                    counts += np.bincount(owner, minlength=len(pieces))
        return (sums / np.maximum(counts, 1)[:, None] + np.where(counts[:, None] > 0, self.b, 0)) / self.temperature, counts > 0

    def calibrate(self, texts: list[str], y: np.ndarray) -> "Model":
        """The temperature with the least loss on held-out sentences."""
        if len(texts):
            raw = self.logits(texts)
            losses = {t: -np.log(np.maximum(softmax(raw / t)[np.arange(len(y)), y], 1e-9)).clip(max=4).mean() for t in (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)}
            self.temperature = min(losses, key=losses.get)
        return self


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(docs: DataFrame, doc_id: str, text: str, lang: str, p: Settings = Settings()) -> Model:
    """Train on at most ``sample`` documents of each label, chosen by a hash of their key."""
    # the language a label names, by the fixed list, inside codegen: a free-text column costs nothing here
    bare = F.lower(F.trim(F.translate(F.col(lang), ACCENTED, PLAIN)))
    known = F.create_map(*(F.lit(x) for pair in sorted(_LABEL.items()) for x in pair))
    said = F.coalesce(known[bare], known[F.get(F.split(bare, "[-_ ]"), F.lit(0))])
    named = docs.filter(F.col(lang).isNotNull()).select(said.alias("y"), F.pmod(F.xxhash64(F.lit(p.seed), doc_id), F.lit(1 << 30)).alias("h"), F.col(text).alias("t")).filter(F.col("y").isNotNull())
    have = {r["y"]: r["n"] for r in named.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # five rows, from two narrow columns
    if not have:
        return Model(p)
    # a scan that keeps some four times the sample by a hash of the key; only what is left is ranked
    limit = F.create_map(*(x for y, n in sorted(have.items()) for x in (F.lit(y), F.lit(min(1 << 30, (4 * p.sample << 30) // n + 1)))))
    rank = F.row_number().over(Window.partitionBy("y").orderBy("h", F.xxhash64("t"), "t"))
    chosen = named.filter((F.col("h") < limit[F.col("y")]) & F.col("t").isNotNull()).withColumn("k", rank).filter(F.col("k") <= p.sample)
    pairs = sorted(((r["t"], r["y"]) for r in chosen.select("t", "y").collect()), key=lambda r: (LANGUAGES.index(r[1]), r[0]))
    whole = [mend(t) for t, _ in pairs]
    cleaned = [[plain(t[a:b]) for a, b in sentences(t)] for t in whole]
    seen: dict[str, int] = {}
    for row, (_, language) in zip(cleaned, pairs):
        for s in row:
            if len(s) > 20:
                seen.setdefault(s, LANGUAGES.index(language))
    if not seen:
        return Model(p)
    first = Model(replace(p, epochs=3)).train(list(seen), np.array(list(seen.values()), np.int64))
    # second round: every sentence gets the language its neighbours in the document speak for, not the document's label
    votes: dict[str, np.ndarray] = {}
    table = first.table()
    for row in cleaned:
        if row:
            score = np.log(np.maximum(softmax(first.logits(row, table)), 1e-6)) * np.minimum(np.array([len(s) for s in row]) / 60, 1.0)[:, None] ** 2
            for s, k in zip(row, path(score, 0.5)):
                if len(s) > 12:
                    votes.setdefault(s, np.zeros(len(LANGUAGES), np.int64))[k] += 1
    out = np.random.default_rng(p.seed + 1).random(len(votes)) < p.held
    train = [(s, int(v.argmax())) for (s, v), h in zip(votes.items(), out) if not h for _ in range(min(int(v.max()), p.repeat))]
    held = [(s, int(v.argmax())) for (s, v), h in zip(votes.items(), out) if h]
    model = Model(p).train([s for s, _ in train], np.array([k for _, k in train], np.int64))
    return model.calibrate([s for s, _ in held], np.array([k for _, k in held], np.int64))


def path(logp: np.ndarray, change: float) -> np.ndarray:
    """The best sequence of languages: per-sentence scores with a cost for each change."""
    n, m = logp.shape
    each = logp.argmax(1)
    if (each == each[0]).all():
        return each
    best = logp[0].copy()
    back = np.zeros((n, m), np.int64)
    for k in range(1, n):
        top = int(best.argmax())
        stay = best >= best[top] - change
        back[k] = np.where(stay, np.arange(m), top)
        best = np.where(stay, best, best[top] - change) + logp[k]
    out = np.empty(n, np.int64)
    out[-1] = best.argmax()
    for k in range(n - 1, 0, -1):
        out[k - 1] = back[k, out[k]]
    return out


def judge(texts: list[str | None], model: Model, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The stretches of all texts, in order: (text, begin, end, language, confidence, letters of its sentences)."""
    p = model.p
    spans = [sentences(t) if t else [] for t in texts]
    counts = np.array([len(s) for s in spans], np.int64)
    at = np.concatenate([[0], np.cumsum(counts)])
    begin, end = (np.array([x[k] for s in spans for x in s], np.int64) for k in (0, 1))
    logits, some = model.score([t[a:b] for t, s in zip(texts, spans) for a, b in s], table)
    q = softmax(logits)
    owner = np.repeat(np.arange(len(texts)), counts)
    size = (end - begin).astype(float)
    none = ~some | (q.max(1) < p.reject)
    score = np.log(np.maximum(q, 1e-6))
    speaks = np.bincount(owner[~none], minlength=len(texts)) > 0  # texts with a sentence that has a language
    score[none & speaks[owner]] *= 0.25  # little weight: such sentences follow their neighbours
    score[~some] = 0
    score *= np.minimum(size / 60, 1.0)[:, None]  # a few letters are little evidence
    chosen = score.argmax(1)
    # only texts whose sentences differ need a path
    change = (chosen[1:] != chosen[:-1]) & (owner[1:] == owner[:-1])
    for k in np.unique(owner[1:][change]):
        chosen[at[k] : at[k + 1]] = path(score[at[k] : at[k + 1]], p.change)
    if not len(owner):
        return owner, begin, end, chosen, np.zeros(0), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.concatenate([first[1:], [len(owner)]]) - 1
    w = size * np.where(none, 0.1, 1.0)
    sure = np.add.reduceat(q[np.arange(len(owner)), chosen] * w, first) / np.add.reduceat(w, first)
    return owner[first], begin[first], end[last], chosen[first], sure, np.add.reduceat(size, first).astype(np.int64)


def stretches(docs: DataFrame, doc_id: str, text: str, lang: str, model: Model) -> DataFrame:
    """doc_id, rotulo (the label as given), lang (of most characters), confianca, trechos: array of (inicio, fim, lang, confianca)."""
    kind = docs.select(doc_id).schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((model.table(), model.b, model.temperature))  # buckets x languages numbers: a fixed size
    settings = model.p
    names = pa.array(LANGUAGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, b, temperature = shared.value
        m = Model.with_table(settings, b, temperature)
        said: dict[str | None, str | None] = {}
        for whole in batches:
            for k in range(0, whole.num_rows, 1024):
                batch = whole.slice(k, 1024)
                n = batch.num_rows
                owner, begin, end, chosen, sure, size = judge(batch.column(1).to_pylist(), m, table)
                letters, weight = np.zeros((n, len(LANGUAGES))), np.zeros((n, len(LANGUAGES)))
                np.add.at(letters, (owner, chosen), size)
                np.add.at(weight, (owner, chosen), size * sure)
                top, total = letters.argmax(1), letters.sum(1)
                absent = total == 0
                confidence = weight[np.arange(n), top] / np.where(absent, 1, total)
                labels = batch.column(2).to_pylist()
                if len(said) > 10_000:  # spellings are few; a free-text column must not fill the memory
                    said.clear()
                for x in set(labels).difference(said):
                    said[x] = label(x)
                pieces = pa.StructArray.from_arrays([pa.array(begin, pa.int32()), pa.array(end, pa.int32()), names.take(pa.array(chosen)), pa.array(sure)], ["inicio", "fim", "lang", "confianca"])
                offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]) if n else np.zeros(1, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array([said[x] for x in labels], pa.string()), names.take(pa.array(top, mask=absent)), pa.array(confidence, mask=absent), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pieces)],
                    names=["doc_id", "rotulo", "nomeia", "lang", "confianca", "trechos"],
                )

    return docs.select(doc_id, text, lang).mapInArrow(run, f"doc_id {kind}, rotulo string, nomeia string, lang string, confianca double, trechos array<struct<inicio:int,fim:int,lang:string,confianca:double>>")
