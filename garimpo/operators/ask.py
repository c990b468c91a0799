"""Questions about prices: names, wish and period read from the question, answered by a plan over the star tables or by search.

A question becomes tokens once. Names are found by one walk through a trie of the vocabulary's tokens, exact and misspelt ones together;
the wish is voted for by a table of cue stems; a period is a shape in the sequence of the tokens' classes. The vocabulary (products,
towns, brands) is a few thousand distinct values: reading a question is driver work, answering it a plan.
"""

from __future__ import annotations

import calendar
import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from difflib import SequenceMatcher

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: months
MONTHS = {m: k for k, m in enumerate("janeiro fevereiro marco abril maio junho julho agosto setembro outubro novembro dezembro".split(), 1)}
# fixed value: least likeness of a misspelt name
LIKE = 0.85
CNPJ = re.compile(r"(?<!\d)\d{2}\.?\d{3}\.?\d{3}/?\d{4}-?\d{2}(?!\d)")


def plain(text: str) -> str:
    """Lower case letters without accents, digits, and the signs a date is written with."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
    return " ".join(re.findall(r"[a-z0-9]+|[/-]", bare))


def words(text: str) -> list[str]:
    return [w for w in plain(text).split() if w not in "/-"]


# --- names -----------------------------------------------------------------------------------------------------------


class Names:
    """A trie over the tokens of all names; each end holds what the name stands for."""

    END = ""  # no token is empty

    def __init__(self) -> None:
        self.root: dict = {}
        self._known: dict = {}

    def add(self, name: str, meaning) -> None:
        at = self.root
        for token in words(name):
            at = at.setdefault(token, {})
        if at is not self.root:
            at.setdefault(self.END, set()).add(meaning)
        self._known = {}

    def _edges(self, at: dict, token: str) -> list[tuple[dict, int]]:
        """(next node, letters lost): the token itself, else, for words of five letters and more, those that are alike. Remembered."""
        if (same := at.get(token)) is not None:
            return [(same, 0)]
        if len(token) < 5 or token.isdigit():
            return []
        if (found := self._known.get((id(at), token))) is None:
            found = self._known[id(at), token] = []
            for other, node in at.items():
                if len(other) > 4 and abs(len(other) - len(token)) < 3:
                    alike = SequenceMatcher(None, token, other, autojunk=False)
                    if alike.quick_ratio() > LIKE and alike.ratio() > LIKE:
                        found.append((node, max(1, len(other) - sum(b.size for b in alike.get_matching_blocks()))))
        return found

    def find(self, tokens: list[str]) -> dict:
        """kind -> value of the best name of that kind: the fewest letters lost, then the most tokens, then letters, then the first."""
        best: dict = {}
        live: list[tuple[dict, int, int, int]] = []
        for k, token in enumerate(tokens):
            live = [(node, begin, lost + more, size + len(token)) for at, begin, lost, size in [*live, (self.root, k, 0, 0)] for node, more in self._edges(at, token)]
            for node, begin, lost, size in live:
                for kind, value in node.get(self.END, ()):
                    rank = (lost, begin - k, -size, value)
                    if kind not in best or rank < best[kind]:
                        best[kind] = rank
        return {kind: rank[-1] for kind, rank in best.items()}


@dataclass
class Vocabulary:
    products: dict[str, str] = field(default_factory=dict)
    towns: dict[str, str] = field(default_factory=dict)
    brands: dict[str, str] = field(default_factory=dict)
    first: date | None = None
    last: date | None = None

    def __post_init__(self) -> None:
        self.names = Names()
        for kind, group in (("product", self.products), ("town", self.towns), ("brand", self.brands)):
            for name, value in group.items():
                self.names.add(name, (kind, value))

    @staticmethod
    def load(current: DataFrame) -> "Vocabulary":
        """One pass over the mart; what is collected are its distinct names."""
        kinds = ["produto", "municipio", "bandeira"]
        row = current.agg(*(F.collect_set(c).alias(c) for c in kinds), F.min("data_coleta").alias("a"), F.max("data_coleta").alias("z")).first()
        return Vocabulary(*({n: n for n in sorted(row[c]) if n.strip()} for c in kinds), row["a"], row["z"])


# --- wishes ----------------------------------------------------------------------------------------------------------

#: cue (stems of successive words), wish, weight; the heaviest wish wins
CUES = (
    ("quantos", "COUNT", 9),
    ("quantas", "COUNT", 9),
    ("quantidade", "COUNT", 9),
    ("numero de", "COUNT", 9),
    ("media", "STATS", 5),
    ("medio", "STATS", 5),
    ("minim", "MIN", 3),
    ("menor", "MIN", 3),
    ("mais barat", "MIN", 3),
    ("mais baix", "MIN", 3),
    ("maxim", "MAX", 3),
    ("maior", "MAX", 3),
    ("mais car", "MAX", 3),
    ("mais alt", "MAX", 3),
    *((f"{verb} {noun}", "LISTA", 1) for verb in ("quais", "list") for noun in ("posto", "revenda", "revendedor")),
)
ARTICLES = {"o", "os", "a", "as"}


def votes(tokens: list[str], cues) -> dict[str, int]:
    """wish -> weight of its heaviest cue in the tokens"""
    out: dict[str, int] = {}
    for cue, wish, weight in cues:
        stems = cue.split()
        for k in range(len(tokens) - len(stems) + 1):
            if all(t.startswith(s) for t, s in zip(tokens[k:], stems)):
                out[wish] = max(out.get(wish, 0), weight)
                break
    return out


def intent(text: str) -> str | None:
    """The wish with the heaviest cue; lowest and highest together ask for the figures."""
    found = votes([w for w in words(text) if w not in ARTICLES], CUES)
    if "MIN" in found and "MAX" in found:
        found["STATS"] = 5
    return max(found, key=lambda w: (found[w], w), default=None)


# --- periods ---------------------------------------------------------------------------------------------------------


def _month(year: int, month: int) -> tuple[date, date]:
    return date(year, month, 1), date(year, month, calendar.monthrange(year, month)[1])


def _day(year: int, month: int, day: int) -> tuple[date, date]:
    return (date(year, month, day),) * 2


#: shape of successive token classes -> the period, from the values of its numbers and months and the newest reading's date
SHAPES: tuple[tuple[str, Callable], ...] = (
    ("Y-N-N", lambda v, last: _day(*v)),
    ("wN?Y", lambda v, last: _month(v[1], v[0])),
    ("N/Y", lambda v, last: _month(v[1], v[0])),
    ("M?Y", lambda v, last: _month(v[1], v[0])),
    ("M", lambda v, last: last and _month(last.year, v[0])),
    ("uw", lambda v, last: last and _month(last.year, last.month)),
    ("wp", lambda v, last: last and _month(last.year, last.month)),
)
_CLASS = {"mes": "w", "ultimo": "u", "passado": "p", "de": "d", "-": "-", "/": "/"}


def period(text: str, last: date | None) -> tuple[date | None, date | None]:
    """First and last day of the period the question names; (None, None) if it names none, or none that exists.

    "?" in a shape is an optional "de"."""
    tokens = plain(text).split()
    classes = "".join("M" if t in MONTHS else ("Y" if len(t) == 4 else "N" if len(t) < 3 else ".") if t.isdigit() else _CLASS.get(t, ".") for t in tokens)
    for shape, make in SHAPES:
        if m := re.search(shape.replace("?", "d?"), classes):
            values = [MONTHS[t] if t in MONTHS else int(t) for t in tokens[m.start() : m.end()] if t in MONTHS or t.isdigit()]
            try:
                return make(values, last) or (None, None)
            except (ValueError, calendar.IllegalMonthError):
                return None, None
    return None, None


# --- questions -------------------------------------------------------------------------------------------------------


@dataclass
class Question:
    cnpj: str | None = None
    product: str | None = None
    town: str | None = None
    brand: str | None = None
    intent: str | None = None
    start: date | None = None
    end: date | None = None

    @property
    def route(self) -> str:
        return "sql" if self.cnpj or (self.intent and (self.product or self.town or self.brand)) else "vector"

    def where(self) -> Column:
        test = F.lit(True)
        for column, value in (("cnpj", self.cnpj), ("produto", self.product), ("municipio", self.town), ("bandeira", self.brand)):
            if value:
                test = test & (F.col(column) == value)
        if self.start:
            test = test & F.col("data_coleta").between(self.start, self.end)
        return test


def read(question: str, v: Vocabulary) -> Question:
    number = CNPJ.search(question)
    rest = CNPJ.sub(" ", question)
    start, end = period(rest, v.last)
    return Question(cnpj=re.sub(r"\D", "", number[0]) if number else None, intent=intent(rest), start=start, end=end, **v.names.find(words(rest)))


def answer(q: Question, current: DataFrame, limit: int = 10) -> DataFrame:
    """The five answers: count, figures, ranking, list, detail."""
    rows = current.filter(q.where())
    if q.intent == "COUNT":
        return rows.agg(F.countDistinct("cnpj").alias("postos"), F.count(F.lit(1)).alias("precos"))
    if q.intent == "STATS":
        return rows.agg(F.round(F.avg("valor_venda"), 4).alias("media"), F.min("valor_venda").alias("minimo"), F.max("valor_venda").alias("maximo"), F.count(F.lit(1)).alias("precos"))
    if q.intent in ("MIN", "MAX"):
        price = F.min("valor_venda") if q.intent == "MIN" else F.max("valor_venda")
        ranked = rows.filter("valor_venda is not null").groupBy("revenda", "municipio", "produto").agg(price.alias("preco"))
        return ranked.orderBy(F.asc("preco") if q.intent == "MIN" else F.desc("preco"), "revenda", "municipio", "produto").limit(limit)
    if q.intent == "LISTA":
        return rows.select("revenda", "municipio").distinct().orderBy("revenda", "municipio").limit(limit).crossJoin(rows.agg(F.countDistinct("revenda", "municipio").alias("total")))
    return rows.select("cnpj", "produto", "valor_venda", "data_coleta").orderBy(F.desc("data_coleta"), "produto", "cnpj").limit(limit)
