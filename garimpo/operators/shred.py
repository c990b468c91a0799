"""Nested documents into related flat tables, by Merkle subtree identities.

Each document is parsed once, on the executor that holds it. Objects are canonicalised (names without namespace,
attributes sorted, blanks around text dropped, comments gone) and hashed bottom-up, so that equal subtrees get equal ids
whatever prefix or layout they were written with. Two readings of a document, with the same ids:

* ``shred``: the groups that a layout names, one row per occurrence: document keys, group, ordinals, the object's id and its parent's
  and, if wanted, all values below it (``campos``), so that a flat table needs neither a second parse nor a join;
* ``store``: every object there is (elements with attributes or children), found from the data: ``links`` has a row per occurrence with
  its number in the document, its parent's number and its ordinal, ``objects`` every distinct object once, whole and in order.
  ``links`` and ``objects`` give back each document (``rebuild``) and every id (``digest``).

Both are narrow transformations: nothing is shuffled but the distinct objects, which are merged within each batch and
on the map side first.

Defined cases: null or blank content and content that is not well-formed (an unbound prefix included) give one row with ``erro``
and nothing else. Repeated rows are repeated occurrences. Empty tables give empty tables. Extra columns are ignored.
Content of any depth works (no recursion). Text around children is one text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Group of the invoice layout -> path below the root object; a star marks a repeated level, which gets an ordinal.
NFE_GROUPS = {
    "det": "det*",
    "rastro": "det*/prod/rastro*",
    "di": "det*/prod/DI*",
    "adi": "det*/prod/DI*/adi*",
    "nfref": "ide/NFref*",
    "dup": "cobr/dup*",
    "detpag": "pag/detPag*",
    "vol": "transp/vol*",
    "lacres": "transp/vol*/lacres*",
}


def _hash(canonical: str) -> str:
    return blake2b(canonical.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


@dataclass(frozen=True)
class Layout:
    """root: the element whose subtree is the document's object tree; groups: see NFE_GROUPS."""

    root: str
    groups: tuple[tuple[str, str], ...]

    @property
    def depth(self) -> int:
        return max(p.count("*") for _, p in self.groups)

    def trie(self) -> dict:
        """name -> [children, group or None, repeated?]"""
        top: dict = {}
        for group, path in self.groups:
            at = top
            steps = path.split("/")
            for k, step in enumerate(steps):
                node = at.setdefault(step.rstrip("*"), [{}, None, step.endswith("*")])
                if k == len(steps) - 1:
                    node[1] = group
                at = node[0]
        return top


NFE = Layout("infNFe", tuple(NFE_GROUPS.items()))


class Shredder:
    """Parses one document at a time with a stack of open objects."""

    def __init__(self, layout: Layout, payload: bool):
        self.root, self.trie, self.payload = layout.root, layout.trie(), payload

    def parse(self, text: str) -> tuple[list[tuple], dict[str, tuple[str, list]], str | None]:
        """(occurrences, fields of the objects, error). An occurrence is (group, ordinals, id, slot of the parent)."""
        # a frame: [name, attributes, canonical parts, text, counters, trie node or None, group, ordinals, parent slot, slot, fields, siblings seen by name]
        stack: list[list] = []
        occurrences: list[list] = []
        objects: dict[str, tuple[str, list]] = {}
        trie, root, payload = self.trie, self.root, self.payload

        def gather(fields: dict, key: str, value: str) -> None:
            if key in fields:
                have = fields[key]
                fields[key] = [*have, value] if isinstance(have, list) else [have, value]
            else:
                fields[key] = value

        def start(name: str, attributes: list[str]) -> None:
            name = name.rpartition(" ")[2]
            frame = [name, attributes, [], None, None, None, None, (), -1, -1, {} if payload else None, {}]
            if stack:
                above = stack[-1]
                node = above[5]
                if node is not None:
                    frame[7], frame[8] = above[7], above[9] if above[6] else above[8]
                    if (hit := node.get(name)) is not None:
                        frame[5], frame[6] = hit[0], hit[1]
                        if hit[2]:
                            counters = above[4]
                            if counters is None:
                                counters = above[4] = {}
                            counters[name] = k = counters.get(name, 0) + 1
                            frame[7] = above[7] + (k,)
                        if hit[1]:
                            frame[9] = len(occurrences)
                            occurrences.append([hit[1], frame[7], None, frame[8]])
            if name == root and (not stack or stack[-1][5] is None):
                frame[5], frame[6], frame[9] = trie, root, len(occurrences)
                occurrences.append([root, (), None, -1])
            stack.append(frame)

        def data(text: str) -> None:
            frame = stack[-1]
            frame[3] = text if frame[3] is None else frame[3] + text

        def end(name: str) -> None:
            frame = stack.pop()
            name, attributes, parts, text, _, _, group, _, _, slot, fields, _ = frame
            text = text.strip() if text else ""
            if attributes:
                pairs = sorted((attributes[k].rpartition(" ")[2], attributes[k + 1]) for k in range(0, len(attributes), 2))
                parts = [f"@{len(a)}:{a}{len(v)}:{v}" for a, v in pairs] + parts
            if not parts:  # a leaf is written into its parent
                piece = f"<{name}|{len(text)}:{text}"
                if fields is not None and stack and (above := stack[-1][10]) is not None:
                    gather(above, name, text)
                    stack[-1][11][name] = stack[-1][11].get(name, 0) + 1
                if stack:
                    stack[-1][2].append(piece)
                if slot < 0:
                    return
                digest = _hash(piece)
            else:
                digest = _hash(f"<{name}|{len(text)}:{text}|{''.join(parts)}")
            if fields is not None:
                for k in range(0, len(attributes), 2):
                    fields["@" + attributes[k].rpartition(" ")[2]] = attributes[k + 1]
                if text:
                    fields["#"] = text
            if slot >= 0:
                occurrences[slot][2] = digest
                if fields is not None and digest not in objects:
                    objects[digest] = (group, [(k, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)) for k, v in fields.items()])
            elif fields and stack and (above := stack[-1][10]) is not None:
                seen = stack[-1][11]
                seen[name] = k = seen.get(name, 0) + 1
                at = name if k == 1 else f"{name}[{k}]"  # a repeated element's values stay together
                for key, value in fields.items():
                    above[at if key == "#" else f"{at}.{key}"] = value
            if stack and parts:
                stack[-1][2].append(f"#{name}{digest}")

        parser = expat.ParserCreate(encoding="utf-8", namespace_separator=" ")
        parser.buffer_text = parser.ordered_attributes = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, data
        try:
            parser.Parse(text.encode("utf-8"), True)
        except (expat.ExpatError, UnicodeEncodeError) as e:
            return [], {}, str(e)[:200]
        return [tuple(o) for o in occurrences], objects, None


class Store:
    """Parses one document at a time into all of its objects."""

    def parse(self, text: str) -> tuple[list[list], dict[str, str], str | None]:
        """(occurrences, objects, error): [number of the element, number of its parent, name, ordinal, id], and id -> canonical JSON.

        Canonical JSON: name, text, sorted attributes, then the children in order: leaves by value, objects by id."""
        # a frame: [name, attributes, canonical parts, text, counters, children, number, ordinal]
        stack: list[list] = []
        occurrences: list[list] = []
        objects: dict[str, str] = {}
        elements = 0

        def start(name: str, attributes: list[str]) -> None:
            nonlocal elements
            elements += 1
            name, ordinal = name.rpartition(" ")[2], 1
            if stack:
                counters = stack[-1][4]
                counters[name] = ordinal = counters.get(name, 0) + 1
            stack.append([name, attributes, [], None, {}, [], elements, ordinal])

        def data(text: str) -> None:
            frame = stack[-1]
            frame[3] = text if frame[3] is None else frame[3] + text

        def end(name: str) -> None:
            name, attributes, parts, text, _, children, number, ordinal = stack.pop()
            text = text.strip() if text else ""
            if not attributes and not parts and stack:
                stack[-1][2].append(f"<{name}|{len(text)}:{text}")
                stack[-1][5].append([name, text])
                return
            pairs = sorted((attributes[k].rpartition(" ")[2], attributes[k + 1]) for k in range(0, len(attributes), 2))
            whole = [f"@{len(a)}:{a}{len(v)}:{v}" for a, v in pairs] + parts
            digest = _hash(f"<{name}|{len(text)}:{text}" + (f"|{''.join(whole)}" if whole else ""))
            if digest not in objects:
                objects[digest] = json.dumps({"n": name, "t": text, "a": pairs, "c": children}, ensure_ascii=False)
            occurrences.append([number, stack[-1][6] if stack else 0, name, ordinal, digest])
            if stack:
                stack[-1][2].append(f"#{name}{digest}")
                stack[-1][5].append([name, None, digest])

        parser = expat.ParserCreate(encoding="utf-8", namespace_separator=" ")
        parser.buffer_text = parser.ordered_attributes = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, data
        try:
            parser.Parse(text.encode("utf-8"), True)
        except (expat.ExpatError, UnicodeEncodeError) as e:
            return [], {}, str(e)[:200]
        return occurrences, objects, None


def digest(canonical: str) -> str:
    """The id of a stored object, from what is stored of it."""
    o = json.loads(canonical)
    parts = [f"@{len(a)}:{a}{len(v)}:{v}" for a, v in o["a"]]
    parts += [f"<{c[0]}|{len(c[1])}:{c[1]}" if len(c) == 2 else f"#{c[0]}{c[2]}" for c in o["c"]]
    return _hash(f"<{o['n']}|{len(o['t'])}:{o['t']}" + (f"|{''.join(parts)}" if parts else ""))


def rebuild(root: str, objects: dict[str, str]) -> list[tuple]:
    """A document from its root's id and the stored objects: (level, name, text, attributes) of every element, in document order."""
    out: list[tuple] = []
    todo: list[tuple] = [(0, root, None)]
    while todo:
        level, at, leaf = todo.pop()
        if leaf is not None:
            out.append((level, leaf[0], leaf[1], ()))
            continue
        o = json.loads(objects[at])
        out.append((level, o["n"], o["t"], tuple(map(tuple, o["a"]))))
        todo += [(level + 1, None, c) if len(c) == 2 else (level + 1, c[2], None) for c in reversed(o["c"])]
    return out


def store(df: DataFrame, keys: list[str], content: str) -> DataFrame:
    """keys, no, no_pai (0: none), nome, ordem, objeto, canonico (once per object and batch), erro: a row per occurrence of any object."""
    schema = df.select(*keys).schema
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "no int, no_pai int, nome string, ordem int, objeto string, canonico string, erro string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Store()
        for batch in batches:
            sent: set[str] = set()
            row, columns = [], [[] for _ in range(7)]
            for k, text in enumerate(batch.column(len(keys)).to_pylist()):
                occurrences, objects, error = ([], {}, "no content") if text is None or not text.strip() else parser.parse(text)
                if error is not None:
                    occurrences = [[None] * 5]
                for o in occurrences:
                    row.append(k)
                    canonical = None if o[4] in sent else objects.get(o[4])
                    if canonical is not None:
                        sent.add(o[4])
                    for column, value in zip(columns, (*o, canonical, error)):
                        column.append(value)
            taken = pa.array(row, pa.int64())
            types = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(taken) for k in range(len(keys))), *(pa.array(c, t) for c, t in zip(columns, types))], names=[*keys, "no", "no_pai", "nome", "ordem", "objeto", "canonico", "erro"])

    return df.select(*keys, F.col(content).alias("__content")).mapInArrow(run, out)


def links(stored: DataFrame) -> DataFrame:
    return stored.filter(F.col("erro").isNull()).drop("canonico", "erro")


def objects(stored: DataFrame) -> DataFrame:
    """Each distinct object once. Equal ids have equal content, so any copy will do."""
    return stored.filter(F.col("canonico").isNotNull()).groupBy("objeto").agg(F.max("nome").alias("nome"), F.max("canonico").alias("canonico"))


def _maps(rows: list[list[tuple[str, str]] | None]) -> pa.Array:
    """A map array from lists of pairs, built from flat columns."""
    if not any(rows):
        return pa.array([None if r is None else [] for r in rows], pa.map_(pa.string(), pa.string()))
    offsets, at = [], 0
    for r in rows:
        offsets.append(None if r is None else at)
        at += len(r) if r else 0
    pairs = [x for r in rows if r for x in r]
    return pa.MapArray.from_arrays(pa.array([*offsets, at], pa.int32()), pa.array([k for k, _ in pairs], pa.string()), pa.array([v for _, v in pairs], pa.string()))


def shred(df: DataFrame, keys: list[str], content: str, layout: Layout = NFE, payload: bool = True, groups: list[str] | None = None) -> DataFrame:
    """Occurrences: keys, grupo, ordem1.., objeto, grupo_pai, objeto_pai, campos, erro.

    A row with ``erro`` stands for a document that was refused. ``payload=False`` leaves ``campos`` empty; ``groups`` names the groups wanted
    (all, if None)."""
    schema = df.select(*keys).schema
    depth = layout.depth
    extra = [f"ordem{k + 1} int" for k in range(depth)]
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), "grupo string", *extra, "objeto string", "grupo_pai string", "objeto_pai string", "campos map<string,string>", "erro string"])
    wanted = None if groups is None else set(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shredder = Shredder(layout, payload)
        for batch in batches:
            known: dict[str, tuple] = {}
            row, group, ordinals, ids, parents, parent_ids, fields, errors = [], [], [[] for _ in range(depth)], [], [], [], [], []
            for k, text in enumerate(batch.column(len(keys)).to_pylist()):
                if text is None or not text.strip():
                    found = ([], {}, "no content")
                elif (found := known.get(text)) is None:  # copies within a batch are parsed once
                    found = known[text] = shredder.parse(text)
                occurrences, values, error = found
                for name, at, digest, slot in [(None, (), None, -1)] if error is not None else occurrences:
                    if wanted is not None and name is not None and name not in wanted:
                        continue
                    row.append(k)
                    group.append(name)
                    for d in range(depth):
                        ordinals[d].append(at[d] if d < len(at) else 0)
                    ids.append(digest)
                    parents.append(occurrences[slot][0] if slot >= 0 else None)
                    parent_ids.append(occurrences[slot][2] if slot >= 0 else None)
                    fields.append(values[digest][1] if digest in values else None)
                    errors.append(error)
            taken = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(taken) for k in range(len(keys))]
                + [pa.array(group, pa.string()), *(pa.array(o, pa.int32()) for o in ordinals), pa.array(ids, pa.string()), pa.array(parents, pa.string()), pa.array(parent_ids, pa.string()), _maps(fields), pa.array(errors, pa.string())],
                names=[*keys, "grupo", *(f"ordem{k + 1}" for k in range(depth)), "objeto", "grupo_pai", "objeto_pai", "campos", "erro"],
            )

    return df.select(*keys, F.col(content).alias("__content")).mapInArrow(run, out)


def bridge(shredded: DataFrame) -> DataFrame:
    return shredded.filter(F.col("erro").isNull()).drop("campos", "erro")


def rejects(shredded: DataFrame, keys: list[str]) -> DataFrame:
    return shredded.filter(F.col("erro").isNotNull()).select(*keys, "erro")


def flat_table(shredded: DataFrame, keys: list[str], group: str, fields: dict[str, str]) -> DataFrame:
    """One flat table: keys, ordinals, objeto, grupo_pai, objeto_pai, ``fields`` (column -> field of the object) and all of its fields
    in ``campos``. A projection of the shredded rows: what stands below an occurrence came with it in the same pass."""
    rows = shredded.filter(F.col("erro").isNull() & (F.col("grupo") == group))
    ordinals = [c for c in rows.columns if c.startswith("ordem")]
    return rows.select(*keys, *ordinals, "objeto", "grupo_pai", "objeto_pai", *(F.col("campos")[path].alias(name) for name, path in fields.items()), "campos")
