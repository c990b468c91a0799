"""Copies of the test tables that are empty, or full of nulls, blanks, repeats and clashing columns."""

from __future__ import annotations

import glob
import os

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq

SOURCE = "/root/testdata/sf0.001"
#: names operators use themselves
CLASHES = ["usual", "motivo", "grupo", "objeto", "id", "shard", "code", "copies", "token", "owner", "component", "lang_", "trechos", "fonte", "tokens", "block", "chave", "periodo", "__v", "q"]


def empty(to: str) -> str:
    for p in glob.glob(f"{SOURCE}/*.parquet"):
        pq.write_table(pq.read_table(p).slice(0, 0), os.path.join(to, os.path.basename(p)))
    return to


def hostile(to: str) -> str:
    """Every column is null in every eleventh row (another one per column), blank in every thirteenth; rows repeat; extra columns."""
    for p in glob.glob(f"{SOURCE}/*.parquet"):
        t = pq.read_table(p)
        t = pa.concat_tables([t, t.slice(0, min(20, t.num_rows))])
        columns = []
        for k, name in enumerate(t.column_names):
            c = t.column(name).combine_chunks()
            at = pa.array([(n + 3 * k) % 11 == 0 for n in range(t.num_rows)])
            c = pc.if_else(at, pa.scalar(None, c.type), c)
            if pa.types.is_string(c.type):
                c = pc.if_else(pa.array([(n + 5 * k) % 13 == 0 for n in range(t.num_rows)]), pa.scalar("  ", c.type), c)
                if t.num_rows and name not in ("source",):
                    c = pc.if_else(pa.array([n == 7 for n in range(t.num_rows)]), pa.scalar("Ç;\"x' \u0000\n" * 3000, c.type), c)
            columns.append(c)
        for name in CLASHES:
            if name not in t.column_names:
                t = t.append_column(name, pa.array(["clash"] * t.num_rows))
                columns.append(t.column(name))
        pq.write_table(pa.table(columns, names=t.column_names), os.path.join(to, os.path.basename(p)))
    return to
