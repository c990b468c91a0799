"""The core's operators against hand-computed cases and brute force; nulls, blanks, ties, repeats, empty tables, extra columns."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from garimpo.functions.clean import date_br, number_key, price, price_ok
from garimpo.operators import control_chart, once, orphans, rejects, shred
from garimpo.operators.latest import latest_and_previous, latest_per_key, set_sync

XML = '<n:NFe xmlns:n="u"><n:infNFe Id="NFe1"><!-- c --><n:ide><n:NFref/><n:NFref><n:r>1</n:r></n:NFref></n:ide>{det}<n:transp><n:vol><n:lacres><n:n>1</n:n></n:lacres><n:lacres/></n:vol></n:transp></n:infNFe></n:NFe>'
DET = '<n:det nItem="1"><n:prod><n:x> A &amp; B </n:x><n:rastro><n:l>9</n:l></n:rastro><n:DI><n:adi/><n:adi/></n:DI><n:DI/></n:prod></n:det>'


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_shred_groups_ordinals_and_identities(spark):
    docs = spark.createDataFrame(
        [(1, "a", XML.format(det=DET + DET), "x"), (1, "b", XML.format(det=DET).replace("n:", "").replace("xmlns:n", "xmlns").replace("xmlnsn", "xmlns"), "x"), (2, "c", "<NFe><infNFe>", "x"), (2, "d", None, None), (2, "e", "  ", None), (2, "f", "<p:NFe/>", None), (3, "g", "<NFe><other/></NFe>", None)],
        "lote_id bigint, arquivo string, conteudo string, grupo string",  # an extra column whose name clashes with the result's
    )
    found = shred.shred(docs, ["lote_id", "arquivo"], "conteudo").cache()
    got = rows(shred.bridge(found).filter("arquivo = 'a' and grupo <> 'infNFe'").select("grupo", "ordem1", "ordem2", "ordem3"))
    assert got == sorted(
        [("nfref", 1, 0, 0), ("nfref", 2, 0, 0), ("vol", 1, 0, 0), ("lacres", 1, 1, 0), ("lacres", 1, 2, 0)]
        + [x for k in (1, 2) for x in [("det", k, 0, 0), ("rastro", k, 1, 0), ("di", k, 1, 0), ("di", k, 2, 0), ("adi", k, 1, 1), ("adi", k, 1, 2)]],
        key=str,
    )
    # equal subtrees have one id, whatever the prefix; both items of a are the same object, stored once
    dets = {r.objeto for r in shred.bridge(found).filter("grupo = 'det'").collect()}
    assert len(dets) == 1
    kept = shred.store(docs, ["lote_id", "arquivo"], "conteudo").cache()
    assert shred.objects(kept).filter(F.col("objeto").isin(list(dets))).count() == 1  # the same ids in both readings
    assert {r.arquivo for r in shred.rejects(found, ["lote_id", "arquivo"]).collect()} == {"c", "d", "e", "f"}
    flat = shred.flat_table(found, ["lote_id", "arquivo"], "det", {"n": "@nItem", "x": "prod.x"})
    assert {(r.n, r.x) for r in flat.collect()} == {("1", "A & B")} and flat.count() == 3
    # every child names a parent that exists
    b = shred.bridge(found)
    assert b.filter("objeto_pai is not null").join(b.select(F.col("objeto").alias("objeto_pai")).distinct(), "objeto_pai", "left_anti").count() == 0
    assert shred.shred(docs.limit(0), ["lote_id", "arquivo"], "conteudo").count() == 0


def test_shred_deep_and_long(spark):
    deep = "<NFe><infNFe><det>" + "<a>" * 5000 + "</a>" * 5000 + "</det></infNFe></NFe>"
    long = "<NFe><infNFe>" + "<det><prod/></det>" * 3000 + "</infNFe></NFe>"
    docs = spark.createDataFrame([("d", deep), ("l", long)], "k string, x string")
    got = {r.k: r.n for r in shred.bridge(shred.shred(docs, ["k"], "x", payload=False)).filter("grupo = 'det'").groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert got == {"d": 1, "l": 3000}


def refs(spark, data):
    return spark.createDataFrame(data, "tabela string, campo string, periodo int, linha_id bigint, dominio string, chave string")


def parents(spark, data):
    return spark.createDataFrame(data, "dominio string, periodo int, chave string")


def test_orphans_incremental(spark):
    state = orphans.OrphanState(spark)
    first = refs(spark, [("t", "f", 1, k, "p", c) for k, c in ((1, "a"), (2, "b"), (3, "b"), (4, None), (5, "z"))] + [("t", "f", None, 6, "p", "a")])
    state.apply(parents(spark, [("p", 1, "a"), ("p", 1, "a"), ("p", 2, "b")]), first)
    ids = lambda: sorted(r.linha_id for r in state.pending().collect())
    assert ids() == [2, 3, 5, 6]
    state.apply(parents(spark, [("p", 1, "b"), ("p", None, "a")]))  # arriving parents resolve, a null period is its own
    assert ids() == [5]
    state.apply(deleted=parents(spark, [("p", 1, "a")]), history=first)  # one of two is left
    assert ids() == [5]
    state.apply(deleted=parents(spark, [("p", 1, "a")]), history=first)
    assert ids() == [1, 5]
    state.apply(references=refs(spark, [("t", "f", 1, 7, "p", "b"), ("t", "f", 1, 8, "p", "q")]))
    assert ids() == [1, 5, 8]
    assert [(r.orfaos, r.chaves) for r in state.snapshot().collect()] == [(3, 3)]
    state.apply(parents(spark, []), refs(spark, []))
    assert ids() == [1, 5, 8]
    with pytest.raises(ValueError):
        state.apply(deleted=parents(spark, []))


def test_orphans_random_against_brute_force(spark):
    rng = random.Random(5)
    state, live, seen = orphans.OrphanState(spark), {}, []
    for _ in range(4):
        add = [("p", rng.randint(1, 2), str(rng.randint(1, 9))) for _ in range(4)]
        new = [("t", "f", rng.randint(1, 2), len(seen) + k, "p", str(rng.randint(1, 12))) for k in range(6)]
        drop = [k for k, n in live.items() if n > 0 and rng.random() < 0.3]
        seen += new
        state.apply(parents(spark, add), refs(spark, new), parents(spark, drop), refs(spark, seen[:-6] or new[:0]) if seen[:-6] else refs(spark, []))
        for k in add:
            live[k] = live.get(k, 0) + 1
        for k in drop:
            live[k] -= 1
        want = sorted(r[3] for r in seen if live.get((r[4], r[2], r[5]), 0) <= 0)
        assert sorted({r.linha_id for r in state.pending().collect()}) == want


def test_number_keys(spark):
    df = spark.createDataFrame([(" 00.123-4 ",), ("0000",), ("-",), ("",), (None,), ("12",)], "c string")
    assert [r[0] for r in df.select(number_key(F.col("c"))).collect()] == ["1234", "0", None, None, None, "12"]


def test_once(spark):
    t = lambda s: datetime.datetime(2026, 1, 1, 0, 0, s)
    data = [("a", t(1), 1), ("a", t(3), 1), ("a", t(3), 2), ("b", None, 1), ("b", t(0), 0), (None, t(1), 1), (None, t(1), 1), ("c", t(1), 5), ("c", t(1), 5)]
    df = spark.createDataFrame(data, "id string, at timestamp, n int").withColumn("shard", F.lit(9))
    kept, dropped = once.deduplicate(df, "id", ["at", "n"])
    assert sorted((r.id or "", r.n) for r in kept.collect()) == [("", 1), ("", 1), ("a", 2), ("b", 0), ("c", 5)]
    assert sorted((r.id, r.n) for r in dropped.collect()) == [("a", 1), ("a", 1), ("b", 1)]
    k, d = once.deduplicate(df.limit(0), "id", ["at", "n"])
    assert k.count() == 0 and d.count() == 0


def test_once_across_batches(spark):
    state, rng, seen = once.SeenState(spark, shards=3), random.Random(2), set()
    for batch in range(4):
        data = [(f"m{rng.randint(1, 60)}", batch * 100 + k) for k in range(40)]
        kept = state.admit(spark.createDataFrame(data, "id string, n int"), "id", ["n"])
        got = {(r.id, r.n) for r in kept.collect()}
        want = {}
        for i, n in data:
            want[i] = max(want.get(i, n), n)
        assert got == {(i, n) for i, n in want.items() if i not in seen}
        seen |= {i for i, _ in data}
    assert {r.id for r in state.dictionary().collect()} == seen
    assert state.dictionary().select("shard", "code").distinct().count() == len(seen)
    assert state.bitmaps().agg(F.sum(F.bitmap_count("bits"))).first()[0] == len(seen)


def day(k):
    return datetime.date(2026, 1, 1) + datetime.timedelta(k)


def test_control_chart(spark):
    rng = random.Random(1)
    data, bad, n = [], {}, 0

    def add(source, d, v, why=None):
        nonlocal n
        n += 1
        data.append((n, source, d, v))
        if why:
            bad[n] = why

    for s in ("x", "y"):
        for k in range(40):
            if k in (7, 20):
                add(s, day(k), 62.0 if k == 7 else 3.0, "salto")
            elif s == "y" and 25 <= k < 32:
                add(s, day(k), 6.33, "parado")
            else:
                add(s, day(k), round(6 + 0.01 * k + rng.random() * 0.1 + k * 1e-5, 5))
    add("x", day(3), -1.0, "impossivel")
    add(None, day(3), 0.0, "impossivel")
    add(None, day(3), 5.0)
    add("x", None, 99.0)
    add("x", day(4), None)
    add("short", day(1), 5.0)
    add("short", day(2), 50.0)
    for k in range(5):
        add("five", day(k), 4.0)  # five equal dates are no run
    for k in range(12):
        add("two", day(k // 2), 4.0 if k % 2 else 4.1)  # two prices a date are no run
    df = spark.createDataFrame(data, "id int, s string, d date, v double").withColumn("usual", F.lit("extra"))
    got = {r.id: r.motivo for r in control_chart.flag(df, ["s"], "d", "v").collect()}
    assert got == bad
    assert control_chart.flag(df.limit(0), ["s"], "d", "v").count() == 0


def test_control_chart_of_a_crowded_source(spark):
    """Hundreds of readings a date, some far off on most dates and on both sides: the others are the usual ones."""
    rng = random.Random(7)
    data, bad = [], set()
    for d in range(30):
        for k in range(500):
            n = len(data)
            v = round((5 + 0.02 * d) * rng.uniform(0.93, 1.07), 3)
            if rng.random() < 0.004:
                bad.add(n)
                v = rng.choice([v * 10, v / 10, v * 1.9, v * 0.45])
            data.append((n, "crowd", day(d), v))
    for n, v in ((1, 5.0), (2, 5.1), (3, 60.0)):  # too few dates for a chart
        data.append((-n, "few", day(0), v))
    data += [(-10 - k, "runs", day(k), 4.0) for k in range(9)] + [(-30, "runs", day(4), 0.0)]  # the impossible price ends the run
    data += [(-40 - k, "zero", day(k), 0.0) for k in range(5)]
    df = spark.createDataFrame(data, "id int, s string, d date, v double")
    got = {r.id for r in control_chart.flag(df, ["s"], "d", "v").collect()}
    assert got == bad | {-3, -30} | {-40 - k for k in range(5)}


def test_orphans_touch_their_own_periods(spark):
    """Ten months: a load opens the folders of its own periods, and a period's index is merged."""
    state = orphans.OrphanState(spark)
    for m in range(1, 11):
        ref = refs(spark, [("t", "f", m, m * 10 + k, "p", c) for k, c in enumerate("abz")] + [("t", "f", 1, m * 1000, "p", "late")])
        state.apply(parents(spark, [("p", m, "a"), ("p", m, "b"), ("p", 1, f"x{m}")]), ref, load=str(m))
        tables = state.versions.current()["tables"]
        assert sum(1 in valid for _, valid in tables["index"]) <= orphans.MERGE and sum(1 in valid for _, valid in tables["pending"]) == 1
        assert all(tables["pending"][-1][1] == sorted({1, m}, key=str) for _ in (0,))
    assert sorted(r.linha_id for r in state.pending().collect()) == sorted([m * 10 + 2 for m in range(1, 11)] + [m * 1000 for m in range(1, 11)])
    assert {(r.carga, r.orfaos) for r in state.snapshots().filter("periodo = 1").collect()} == {(str(m), m + 1) for m in range(1, 11)}
    assert state.index().filter("periodo = 1").groupBy("chave").count().count() == 12
    assert orphans.OrphanState(spark).snapshots().count() == 0 and orphans.OrphanState(spark).snapshot().count() == 0


GOOD = "S;SP;X;R;1;A;1;;B;8;ETANOL;04/07/2025;5,52;;R$;RU"
LINES = {
    GOOD: None,
    GOOD + "\r": None,
    GOOD.replace(";X;", ';"X; ""q""";'): None,
    GOOD.replace("5,52", ""): None,
    GOOD.replace("5,52", " +5.5 "): None,
    GOOD.replace("RU", ""): None,
    GOOD + ";z": "17 columns",
    GOOD[:-3]: "15 columns",
    GOOD.replace(";X;", ';"X;'): "x",
    GOOD.replace("RU", '"RU'): "x",
    GOOD.replace(";X;", ';a"b;'): "x",
    GOOD.replace(";X;", ';"X"y;'): "x",
    GOOD.replace(";X;", '; "X";'): "x",
    GOOD.replace("04/07", "31/02"): "x",
    GOOD.replace("04/07", "4/7"): "x",
    GOOD.replace("04/07/2025", ""): "x",
    GOOD.replace("5,52", "1e5"): "x",
    GOOD.replace("5,52", "NaN"): "x",
    GOOD.replace("5,52", "5,"): "x",
    GOOD.replace(";X;", ";" + "Y" * 300_000 + ";"): None,
}


def test_lines(spark):
    data = [(k, line, "f") for k, line in enumerate(LINES)] + [(100, "   ", "f"), (101, None, "f"), (102, "\r", "f")]
    df = spark.createDataFrame(data, "linha_id bigint, linha string, motivo string").drop("motivo").repartition(1)
    got = {r.linha_id: r.motivo for r in rejects.read_lines(df, ["linha_id"], "linha").collect()}
    assert set(got) == set(range(len(LINES)))
    for k, (line, why) in enumerate(LINES.items()):
        assert (got[k] is None) == (why is None), (line[:100], got[k])
    assert rejects.read_lines(df.limit(0), ["linha_id"], "linha").count() == 0


def test_fields(spark):
    data = [(1, "01/02/2025", "5,1"), (2, "29/02/2025", "5"), (3, None, "5"), (4, " 01/02/2025 ", None), (5, "01/02/2025", "5,1,1"), (6, "01/02/2025", "inf"), (7, "01/02/2025", 'a"b;c\nd'), (8, "2025-02-01", ""), (9, "01/02/2025", "")]
    df = spark.createDataFrame(data, "k int, data_da_coleta string, valor_de_venda string").withColumn("motivo", F.lit(1))
    assert sorted(r.k for r in rejects.reject_fields(df, ["k"], rejects.ANP_FIELDS).collect()) == [2, 3, 5, 6, 7, 8]
    # the same rules as expressions
    ok = df.filter(price_ok(F.col("valor_de_venda")) & date_br(F.col("data_da_coleta")).isNotNull())
    assert sorted(r.k for r in ok.collect()) == [1, 4, 9]
    assert [r[0] for r in ok.orderBy("k").select(price(F.col("valor_de_venda"))).collect()] == [5.1, None, None]
    assert rejects.reject_fields(df.limit(0), ["k"], rejects.ANP_FIELDS).count() == 0


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 7.0), ("b", 1, None), (None, 1, 1.0)], "k string, t int, v double")
    assert rows(latest_per_key(df, ["k"], [F.desc("t")])) == [("a", 2, 7.0), ("b", 1, None), (None, 1, 1.0)]
    assert rows(latest_and_previous(df, ["k"], [F.desc("t")], "v")) == [("a", 7.0, 5.0, 2, 2.0), ("b", None, None, 1, None), (None, 1.0, None, 1, None)]
    stored = spark.createDataFrame([("a", 1, 1.0), ("z", 1, 1.0)], df.schema)
    assert {(r.k, r.acao) for r in set_sync(df, stored, ["k"]).collect()} == {("a", "mantida"), ("b", "nova"), ("z", "obsoleta"), (None, "nova")}


def test_lines_are_loaded_by_the_reader(monkeypatch):
    import dataclasses
    import random

    import duckdb

    line = "S;SP;CIDADE;POSTO;1;RUA;1;;CENTRO;1;GASOLINA;{};{};;R$;X"
    clean = [line.format(f"0{k}/03/2026", f"5,{k}9") for k in range(1, 9)]

    def never(text):
        raise AssertionError("exact check of a clean line")

    blind = dataclasses.replace(rejects.ANP_LINE, checks={c: (rule, never) for c, (rule, _) in rejects.ANP_LINE.checks.items()})
    assert rejects.judge_block(clean, blind) == [(x.split(";"), None) for x in clean]
    rng = random.Random(5)
    dates = ["01/02/2026", "1/2/2026", "31/02/2026", " 01/02/2026", "01/02/26", "", "\x01", "2026-02-01", "01/02/2026 10:00", "01/02/0000", '"01/02/2026"', "01/02/2026\t", "00001/02/2026"]
    prices = ["5,99", "5.99", "", " ", "abc", "\x01", "5,99,1", "+5", ".5", "5,", "1e3", '"5', "5\rx", " 5,9 ", "5;9", "٥", "5\t"]
    lines = [line.format(rng.choice(dates), rng.choice(prices)) + rng.choice(["", "", "\rY", ";", '"', "\0"]) for _ in range(400)]
    width = len(rejects.ANP_LINE.columns)
    for text, (fields, reason) in zip(lines, rejects.judge_block(lines, rejects.ANP_LINE)):
        want = rejects.split_line(text)
        good = want is not None and len(want) == width and rejects.is_date(want[11]) and rejects.is_price(want[12])
        assert (reason is None) == good, text
        assert not good or [x.strip() if k == 11 else x for k, x in enumerate(want)] == [x.strip() if k == 11 else x for k, x in enumerate(fields)]

    def broken(lines, contract):
        raise failure

    monkeypatch.setattr(rejects, "duckdb_rejects", broken)
    failure = duckdb.InvalidInputException("given up")
    assert [f for f, _ in rejects.judge_block(clean, rejects.ANP_LINE)] == [x.split(";") for x in clean]
    failure = ImportError("no reader")
    with pytest.raises(ImportError):
        rejects.judge_block(clean, rejects.ANP_LINE)


def test_older_loads_are_refused_by_the_bits(spark, monkeypatch):
    from garimpo.plans import problems

    asked = []
    admit = once.SeenState.admit

    def counted(self, rows, identifier, order):
        kept = admit(self, rows, identifier, order)
        asked.append((rows.filter(F.col(identifier).isNotNull()).select(identifier).distinct().count(), kept.count()))
        return kept

    monkeypatch.setattr(once.SeenState, "admit", counted)
    day = lambda m, d: datetime.datetime(2026, m, d)
    data = [("a" * 44, day(1, 5), 1), ("a" * 44, day(2, 5), 2), ("a" * 44, day(2, 3), 3), ("b" * 44, None, 4), ("b" * 44, day(1, 1), 5), ("c" * 44, None, 6), (None, day(1, 1), 7)]
    df = spark.createDataFrame([(None, f"<infNFe Id='NFe{ {'a': '1', 'b': '2', 'c': '3'}[k[0]] * 44 }'/>" if k else "<x/>", at, "lote", str(n)) for k, at, n in data], "chave_acesso string, conteudo string, carregado_em timestamp, lote_id string, arquivo string")
    monkeypatch.setattr(problems, "table", lambda *_: df)
    assert sorted(r.arquivo for r in problems.p3_kept(spark, "").collect()) == ["2", "5", "6", "7"]
    assert asked == [(1, 1), (2, 1), (2, 1)]
    assert sorted(r.arquivo for r in problems.p3_found(spark, "").collect()) == ["1", "3", "4"]


def test_a_flat_table_per_group(spark, monkeypatch):
    from garimpo.plans import problems

    text = """<NFe><infNFe Id="1"><ide><NFref><refNFe>9</refNFe></NFref></ide><det nItem="1"><prod><cProd>c</cProd><DI><nDI>d</nDI><xLoc>porto</xLoc><adi><nAdicao>1</nAdicao></adi><adi><nAdicao>2</nAdicao></adi></DI><rastro><nLote>L</nLote></rastro></prod></det>
    <transp><vol><qVol>3</qVol><lacres><nLacre>s</nLacre></lacres></vol></transp><cobr><dup><nDup>1</nDup><vDup>5</vDup></dup></cobr><pag><detPag><tPag>01</tPag></detPag></pag></infNFe></NFe>"""
    df = spark.createDataFrame([("lote", "a", text)], "lote_id string, arquivo string, conteudo string")
    monkeypatch.setattr(problems, "table", lambda *_: df)
    got = {g: problems.QUERIES["p1_items" if g == "det" else f"p1_{g}"](spark, "").collect() for g in shred.NFE_GROUPS}
    assert {g: len(r) for g, r in got.items()} == {g: 2 if g == "adi" else 1 for g in shred.NFE_GROUPS}
    assert sorted((r.ordem1, r.ordem2, r.ordem3, r.n_adicao, r.grupo_pai) for r in got["adi"]) == [(1, 1, 1, "1", "di"), (1, 1, 2, "2", "di")]
    assert {r.objeto_pai for r in got["adi"]} == {got["di"][0].objeto} and got["di"][0].objeto_pai == got["det"][0].objeto == got["rastro"][0].objeto_pai
    assert got["di"][0].campos == {"nDI": "d", "xLoc": "porto"} and got["lacres"][0].objeto_pai == got["vol"][0].objeto
    assert (got["nfref"][0].ref_nfe, got["dup"][0].v_dup, got["detpag"][0].t_pag, got["vol"][0].q_vol, got["rastro"][0].n_lote) == ("9", "5", "01", "3", "L")


NESTED = '<infNFe><autXML><CNPJ>1</CNPJ></autXML><autXML><CNPJ>2</CNPJ></autXML><infAdic><obsCont xCampo="a"><xTexto>t</xTexto></obsCont><obsCont xCampo="b"><xTexto>u</xTexto></obsCont><nota tipo="x">texto</nota></infAdic></infNFe>'


def test_fields_keep_nested_values():
    _, objects, _ = shred.Shredder(shred.NFE, True).parse(NESTED)
    [(_, fields)] = objects.values()
    assert dict(fields) == {"autXML.CNPJ": "1", "autXML[2].CNPJ": "2", "infAdic.obsCont.@xCampo": "a", "infAdic.obsCont[2].@xCampo": "b", "infAdic.obsCont.xTexto": "t", "infAdic.obsCont[2].xTexto": "u", "infAdic.nota": "texto", "infAdic.nota.@tipo": "x"}


def elements(text):
    """(level, name, text, attributes) of every element by another parser."""
    import xml.etree.ElementTree as E

    def walk(e, level):
        whole = (e.text or "") + "".join(c.tail or "" for c in e)
        bare = lambda n: n.rpartition("}")[2]
        yield level, bare(e.tag), whole.strip(), tuple(sorted((bare(a), v) for a, v in e.attrib.items()))
        for c in e:
            yield from walk(c, level + 1)

    return list(walk(E.fromstring(text.encode()), 0))


def test_documents_are_rebuilt_from_the_store(spark):
    import os

    texts = [NESTED, "<a/>", "<a> x </a>", '<a b="1" c=""/>', XML.format(det=DET + DET), "<a>x<b/>y<b/> z</a>", "<a><b>" * 3 + "</b></a>" * 3, "<a", None, ""]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, x string")
    if os.path.isdir("/root/testdata/sf0.01"):
        docs = docs.unionByName(spark.read.parquet("/root/testdata/sf0.01/nfe_xml.parquet").select((F.monotonically_increasing_id() + 100).cast("int").alias("k"), F.col("conteudo").alias("x")))
    docs = docs.cache()
    found = shred.store(docs, ["k"], "x").cache()
    objects = {r.objeto: r.canonico for r in shred.objects(found).collect()}
    assert all(shred.digest(c) == o for o, c in objects.items())
    rows_ = shred.links(found).collect()
    roots = {r.k: r.objeto for r in rows_ if r.no_pai == 0}
    refused = {r.k for r in found.filter("erro is not null").collect()}
    for r in docs.collect():
        if r.k in refused:
            continue
        assert shred.rebuild(roots[r.k], objects) == elements(r.x)
    assert {7, 8, 9} <= refused and len(roots) + len(refused) == docs.count()
    # each occurrence names its parent's occurrence, and its siblings' ordinals are dense
    at = {(r.k, r.no): r for r in rows_}
    assert all(r.no_pai == 0 or (r.k, r.no_pai) in at for r in rows_)
    assert [(r.nome, r.ordem) for r in sorted(rows_, key=lambda r: (r.k, r.no)) if r.k == 0] == [("infNFe", 1), ("autXML", 1), ("autXML", 2), ("infAdic", 1), ("obsCont", 1), ("obsCont", 2), ("nota", 1)]
