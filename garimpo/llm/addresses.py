"""Which address records denote the same location, however they are written.

1. Distinct writings per owner (a map-side aggregate: an owner with a third of all rows becomes a few rows), parsed into
   components: street type, title, name tokens, road code, number or kilometre, unit.
2. Equal parsed addresses in one town become one class. Classes that share town and number are candidates of each other only
   if they also share a deletion variant (up to two letters left out) of a name token; towns are the blocks, as postcodes are often
   missing or too wide, and classes alone at their town and number drop out first.
3. A candidate pair is decided by the best assignment of its tokens to each other (exact, by augmenting paths, for any number of tokens) under an
   edit limit per token; an initial stands for its word, one word of three may be missing; a different number, kilometre or road code, two
   different known street types or titles, and, if wanted, two different known units veto it.
4. Owners and classes that are linked form components; the result is each pair of owners in one component.

Defined cases: rows without owner, town, street or number say nothing; blank and null fields are missing parts; ties do not
occur (a pair is decided on its own); repeated rows change nothing; empty tables give empty results; extra columns are ignored; very
long fields are parsed whole.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from garimpo.functions.text import fold as plain
from garimpo.llm.components import components
from garimpo.workspace import cut

# fixed values: abbreviations of street types
TYPES = {
    "RUA": "RUA R",
    "AVENIDA": "AVENIDA AV AVE AVN AVEN AVDA",
    "TRAVESSA": "TRAVESSA TV TRAV TRV",
    "PRACA": "PRACA PC PCA PRC PRA",
    "ALAMEDA": "ALAMEDA AL ALAM",
    "ESTRADA": "ESTRADA EST ESTR",
    "RODOVIA": "RODOVIA ROD RDV RODOV",
    "LARGO": "LARGO LGO LRG",
    "VIA": "VIA",
    "VIELA": "VIELA",
    "BECO": "BECO BC",
    "LADEIRA": "LADEIRA LAD",
}
# fixed values: abbreviations of titles in street names
TITLES = {
    "MARECHAL": "MARECHAL MAL",
    "ENGENHEIRO": "ENGENHEIRO ENG ENGO",
    "PREFEITO": "PREFEITO PREF",
    "DOUTOR": "DOUTOR DR",
    "DOUTORA": "DOUTORA DRA",
    "CORONEL": "CORONEL CEL",
    "DONA": "DONA DNA D",
    "SANTA": "SANTA STA",
    "SANTO": "SANTO STO",
    "SAO": "SAO S",
    "PROFESSOR": "PROFESSOR PROFESSORA PROF PROFA",  # PROF. is written for both
    "GENERAL": "GENERAL GEN GAL",
    "PRESIDENTE": "PRESIDENTE PRES",
    "GOVERNADOR": "GOVERNADOR GOV",
    "SENADOR": "SENADOR SEN",
    "DEPUTADO": "DEPUTADO DEP",
    "VEREADOR": "VEREADOR VER",
    "CAPITAO": "CAPITAO CAP",
    "MAJOR": "MAJOR MAJ",
    "TENENTE": "TENENTE TEN",
    "PADRE": "PADRE PE",
    "BARAO": "BARAO",
    "VISCONDE": "VISCONDE VISC",
    "COMENDADOR": "COMENDADOR COM",
    "DOM": "DOM",
}
# fixed values: words that carry no name
LINKS = {"DA", "DE", "DO", "DAS", "DOS", "E"}
# fixed values: numerals
UNITS = "UM DOIS TRES QUATRO CINCO SEIS SETE OITO NOVE DEZ ONZE DOZE TREZE QUATORZE QUINZE DEZESSEIS DEZESSETE DEZOITO DEZENOVE VINTE".split()
NUMERALS = {w: k for k, w in enumerate(UNITS, 1)} | {"PRIMEIRO": 1, "CATORZE": 14, "TRINTA": 30}
MONTHS = set("JANEIRO FEVEREIRO MARCO ABRIL MAIO JUNHO JULHO AGOSTO SETEMBRO OUTUBRO NOVEMBRO DEZEMBRO".split())

_TYPE = {w: t for t, words in TYPES.items() for w in words.split()}
_TITLE = {w: t for t, words in TITLES.items() for w in words.split()}
_KM = re.compile(r"\bKM\s*\.?\s*([0-9]+)\b")
_ROAD = re.compile(r"\b([A-Z]{2,3})\s*-?\s*([0-9]{2,4})\b")
_TAIL = re.compile(r"(?:,|\bN\s*O?\s*\.?|\s)\s*([0-9]{1,6})\s*$")
_NUMBER = re.compile(r"^(?:N\s*O?\s*[.:]?\s*)?([0-9]+)\b")
_IN_UNIT = re.compile(r"^(?:N\s*O?\s*[.:]?\s*)([0-9]+)\b\s*(.*)$")
_NONE = re.compile(r"^S\s*/?\s*N\s*O?$")


def fold(text: str | None) -> str:
    """Upper case without accents; anything but letters, digits and separators is a blank."""
    if not text:
        return ""
    t = unicodedata.normalize("NFKD", text).upper()
    t = "".join(c for c in t if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", re.sub(r"[^A-Z0-9,/.\- ]", " ", t)).strip()


def parse(street: str | None, number: str | None, unit: str | None) -> tuple[str, str, list[str], str, str] | None:
    """(type, title, name tokens, number key, unit); None if street or number is missing."""
    s, n, u = fold(street), fold(number), fold(unit)
    if not s:
        return None
    key = ""
    km = _KM.search(s)
    if km:
        s = s[: km.start()] + " " + s[km.end() :]
    else:
        km = _KM.search(n) or _KM.search(u)
    road = None
    head = re.split(r"[ .,]+", s, maxsplit=1)[0]
    if _TYPE.get(head) in ("RODOVIA", "ESTRADA") and (road := _ROAD.search(s[len(head) :])):
        name = [f"{road[1]}{int(road[2])}"]
        rest = s[len(head) + road.end() :]
        if km is None and (t := _TAIL.search(" " + rest)):
            key = t[1]
        kind, title = "RODOVIA", ""
    else:
        if t := _TAIL.search(s):
            before = s[: t.start()].strip(" ,.-")
            words = re.split(r"[ .,\-/]+", before)
            if [w for w in words if w and w not in _TYPE and w not in LINKS and w not in ("N", "NO")]:
                key, s = t[1], before
        s = re.sub(r"[, ]+N\s*O?\s*\.?$", "", s)
        front, comma, back = s.rpartition(",")
        if comma and (w := re.sub(r"[^A-Z]", "", back)) in _TYPE and front.strip():
            s = f"{w} {front}"
        words = [w for w in re.split(r"[ .,\-/]+", s) if w]
        kind = ""
        if len(words) > 1 and words[0] in _TYPE:
            kind, words = _TYPE[words[0]], words[1:]
        title = ""
        if len(words) > 1 and words[0] in _TITLE:
            title, words = _TITLE[words[0]], words[1:]
        name = [w for w in words if w not in LINKS] or words
        if name and name[-1] in MONTHS and len(words) >= 2:
            values = [NUMERALS[w] for w in name[:-1] if w in NUMERALS]
            if values and len(values) == len(name) - 1:
                name = [str(sum(values)), name[-1]]
        name = [str(int(w)) if w.isdigit() else w for w in name]
    if not name:
        return None
    if km:
        key = km[1]
    if not key:
        if n and not _NONE.match(n) and (m := _NUMBER.match(n)):
            key = m[1]
        elif m := _IN_UNIT.match(u):
            key, u = m[1], m[2]
        elif u.isdigit():
            key, u = u, ""
    if not key:
        return None
    return kind, title, name, str(int(key)), re.sub(r"[^A-Z0-9]+", " ", u).strip()


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions of neighbours; ``most`` + 1 stands for anything above."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


def edits(token: str) -> int:
    """Edits a token may carry: none in codes and numbers, two in long words."""
    return 0 if any(c.isdigit() for c in token) or len(token) < 4 else 1 if len(token) < 6 else 2


def token_cost(x: str, y: str) -> int | None:
    """What it costs that one token is the other: its edits within the limit, 1 for an initial, None if it can't be."""
    if min(len(x), len(y)) == 1 and x != y:
        return 1 if x[0] == y[0] and (x + y).isalpha() else None
    most = 0 if x in MONTHS and y in MONTHS else min(edits(x), edits(y))  # July is no misspelt June
    d = osa(x, y, most)
    return d if d <= most else None


def assignment(a: list[str], b: list[str]) -> int | None:
    """Least total cost over all assignments of the tokens, None if there is none: exact, by shortest augmenting paths.

    Every token of the shorter name finds its own in the longer one. What is left there is a missing part: one word of three may be, at a cost of
    2, but no number or code; and at least one word of more than a letter must be matched."""
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if not n or m - n > m // 3:
        return None
    far = 1 << 20
    cost = [[far if (c := token_cost(x, y)) is None else c for y in b] for x in a]
    if any(min(row) == far for row in cost):
        return None
    # potentials u, v; match[j]: row of column j (1-based, 0: none)
    u, v, match = [0] * (n + 1), [0] * (m + 1), [0] * (m + 1)
    for row in range(1, n + 1):
        match[0], at = row, 0
        least, back, done = [far * 4] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while match[at]:
            done[at] = True
            r, delta, nearest = match[at], far * 4, 0
            for j in range(1, m + 1):
                if not done[j]:
                    c = cost[r - 1][j - 1] - u[r] - v[j]
                    if c < least[j]:
                        least[j], back[j] = c, at
                    if least[j] < delta:
                        delta, nearest = least[j], j
            for j in range(m + 1):
                if done[j]:
                    u[match[j]] += delta
                    v[j] -= delta
                else:
                    least[j] -= delta
            at = nearest
        while at:
            match[at] = match[back[at]]
            at = back[at]
    pairs = [(match[j] - 1, j - 1) for j in range(1, m + 1) if match[j]]
    left = [b[j - 1] for j in range(1, m + 1) if not match[j]]
    total = sum(cost[i][j] for i, j in pairs)
    if total >= far or any(any(c.isdigit() for c in t) for t in left) or all(min(len(a[i]), len(b[j])) == 1 for i, j in pairs) and a != b:
        return None
    return total + 2 * len(left)


def same_name(a: list[str], b: list[str]) -> bool:
    if assignment(a, b) is not None:
        return True
    x, y = "".join(a), "".join(b)  # a blank lost or gained
    if any(c.isdigit() for c in x + y) or min(len(x), len(y)) < 6:
        return x == y
    return osa(x, y, 2) <= 2


def compatible(a: str, b: str) -> bool:
    return not a or not b or a == b


_PARSED = T.StructType([T.StructField("kind", T.StringType()), T.StructField("title", T.StringType()), T.StructField("name", T.ArrayType(T.StringType())), T.StructField("number", T.StringType()), T.StructField("unit", T.StringType())])


@F.pandas_udf(_PARSED)
def parsed(street: pd.Series, number: pd.Series, unit: pd.Series) -> pd.DataFrame:
    rows = [parse(*x) or (None, None, None, None, None) for x in zip(street, number, unit)]
    return pd.DataFrame(rows, columns=["kind", "title", "name", "number", "unit"])


def variants(token):
    """The token and all strings with one or two letters left out; codes and short tokens only themselves."""
    one = lambda t: F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(t.substr(F.lit(1), i - 1), t.substr(i + 1, F.length(t))))
    less = one(token)
    plain = token.rlike("[0-9]") | (F.length(token) < 4)
    return F.when(plain, F.array(token)).when(F.length(token) < 6, F.array_union(F.array(token), less)).otherwise(F.array_union(F.array_union(F.array(token), less), F.flatten(F.transform(less, one))))


def locations(df: DataFrame, owner: str, town: list[str], street: str, number: str, unit: str, unit_veto: bool = False) -> DataFrame:
    """(owner, component) of the owners that share a location with another one; an owner may be in several."""
    # written out: else the optimizer takes this distinct for redundant and every row is parsed
    raw = cut(df.filter(F.col(owner).isNotNull()).select(F.col(owner).alias("owner"), *(F.col(c).alias(f"t{k}") for k, c in enumerate(town)), F.col(street).alias("s"), F.col(number).alias("n"), F.col(unit).alias("u")).distinct(), "writings")
    texts = raw.select("owner", F.concat_ws("|", *(F.nullif(F.upper(plain(F.col(f"t{k}"))), F.lit("")) for k in range(len(town)))).alias("town"), F.col(f"t{len(town) - 1}").alias("last"), parsed("s", "n", "u").alias("p"))
    unit_part = F.col("p.unit") if unit_veto else F.lit("")
    known = cut(
        texts.filter(F.col("p.number").isNotNull() & (F.length(F.trim("last")) > 0))
        .select("owner", "town", "p.number", "p.kind", "p.title", "p.name", unit_part.alias("unit"))
        .distinct()
        .withColumn("class", F.unhex(F.md5(F.concat_ws("|", "town", "number", "kind", "title", "unit", F.concat_ws(" ", "name"))))),
        "addresses",
    )
    # several owners at one town and number, or nothing to find there
    shared = known.groupBy("town", "number").agg(F.min("owner").alias("lo"), F.max("owner").alias("hi")).filter("lo <> hi").select("town", "number")
    places = cut(known.join(shared, ["town", "number"], "left_semi"), "places")
    classes = cut(places.select("class", "town", "number", "kind", "title", "name", "unit").distinct(), "classes")
    # the index holds a class and a hash only; the names come back to the pairs that were found. Words run together meet by the joined
    # neighbours, written without a letter less
    joined = F.when(F.size("name") > 1, F.transform(F.sequence(F.lit(0), F.size("name") - 2), lambda k: F.concat(F.get("name", k), F.get("name", k + 1)))).otherwise(F.array().cast("array<string>"))
    keys = F.array_union(F.flatten(F.transform("name", variants)), F.array_union(joined, F.array(F.array_join("name", ""))))
    index = classes.select("class", F.concat_ws("|", "town", "number").alias("block"), F.explode(keys).alias("v")).select("class", F.xxhash64("block", "v").alias("h"))
    # merged, whatever the planner thinks of its size: a small table of classes makes a large index
    met = index.select(F.col("class").alias("class_a"), "h").join(index.select(F.col("class").alias("class_b"), "h").hint("merge"), "h").filter("class_a < class_b").select("class_a", "class_b").distinct()
    what = ["kind", "title", "name", "unit"]
    side = lambda x: classes.select(F.col("class").alias(f"class_{x}"), *(F.col(c).alias(f"{c}_{x}") for c in what))
    fits = lambda c: (F.col(f"{c}_a") == "") | (F.col(f"{c}_b") == "") | (F.col(f"{c}_a") == F.col(f"{c}_b"))
    pairs = met.join(side("a"), "class_a").join(side("b"), "class_b").filter(fits("kind") & fits("title") & fits("unit"))

    @F.pandas_udf("boolean")
    def decided(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([same_name(list(x), list(y)) for x, y in zip(a, b)], dtype=bool)

    links = pairs.filter(decided("name_a", "name_b")).select(F.hex("class_a").alias("a"), F.hex("class_b").alias("b"))
    # an owner ties its own writings at one number together: node ids are told apart by a prefix
    own = places.select(F.concat(F.lit("~"), "owner", F.lit("|"), "town", F.lit("|"), "number").alias("a"), F.hex("class").alias("b")).distinct()
    labels = components(links.unionByName(own))
    return places.select("owner", F.hex("class").alias("class")).join(labels, F.col("class") == F.col("node")).select("owner", "component").distinct()


def same_location(df: DataFrame, owner: str, town: list[str], street: str, number: str, unit: str, unit_veto: bool = False) -> DataFrame:
    """(a, b), a < b: each pair of owners at one location. The pairs are the result asked for; everything before them is linear."""
    at = cut(locations(df, owner, town, street, number, unit, unit_veto), "locations")
    return at.select(F.col("owner").alias("a"), "component").join(at.select(F.col("owner").alias("b"), "component"), "component").filter("a < b").select("a", "b").distinct()
