"""Upserts, snapshots, quality rules, sources, questions and legal texts by hand-computed cases."""

import datetime
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from garimpo.functions import keys, text
from garimpo.operators import ask, law, quality, retrieval, upsert
from garimpo.sources import files
from garimpo.workspace import fresh


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_keyed_upsert_and_target(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    delta = spark.createDataFrame([(2, "B"), (3, "c"), (None, "N")], "k int, v string")
    assert rows(upsert.keyed_upsert(base, delta, ["k"])) == [(1, "a"), (2, "B"), (3, "c"), (None, "N")]
    assert rows(upsert.keyed_upsert(base, delta.limit(0), ["k"])) == rows(base)
    t = upsert.Target(spark, fresh(spark, "t"))
    assert t.read() is None and not t.up_to_date(v=1)
    t.upsert(base, ["k"], v=1)
    t.upsert(delta, ["k"], v=2)  # reads the version it replaces
    assert rows(t.read()) == [(1, "a"), (2, "B"), (3, "c"), (None, "N")] and t.up_to_date(v=2) and not t.up_to_date(v=1)


def test_target_rewrites_little(spark):
    """Twenty-four loads: the last ones write as much as the first ones, and the table is what full rewrites give."""
    rng = random.Random(2)
    t, want, written, tiers = upsert.Target(spark, fresh(spark, "tiers")), {}, [], []
    for load in range(24):
        delta = {k: load for k in rng.sample(range(4000), 60)}
        want |= delta
        t.upsert(spark.createDataFrame([*delta.items()], "k int, v int").coalesce(1), ["k"])
        now = t.versions.current()
        tiers.append(len(now["rows"]))
        written.append(now["rows"][-1])
    assert {r.k: r.v for r in t.read().collect()} == want and t.read().count() == len(want)
    assert max(tiers) <= 6 and sum(written) < 24 * 60 * 6
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([(1, 1)], "k int, v int"), ["v"])


def test_classify_and_guard(spark):
    stored = spark.createDataFrame([(1, "a", 1), (2, None, 1), (3, "c", 1), (4, "d", 1)], "k int, v string, s int")
    wanted = spark.createDataFrame([(1, "a", 2), (2, "", 1), (3, "c", 1), (5, "e", 1)], "k int, v string, s int")
    actions = upsert.classify(stored, wanted, ["k"], ["v"], ["s"])
    assert rows(actions) == [(1, "recarimbada"), (2, "alterada"), (3, "igual"), (4, "removida"), (5, "inserida")]
    with pytest.raises(upsert.MassDelete):
        upsert.guard_mass_delete(actions)
    assert upsert.guard_mass_delete(actions, 0.5)["removida"] == 1


def test_history_takes_late_events(spark):
    t = lambda d: datetime.datetime(2026, 1, d)
    data = [("x", "SP", t(5)), ("x", "SP", t(9)), ("x", "RJ", t(7)), (None, "SP", t(1)), ("x", "SP", t(2))]
    df = spark.createDataFrame(data, "doc string, uf string, at timestamp").withColumn("at", F.col("at").cast("timestamp_ntz"))
    lit = lambda s: F.expr(f"timestamp_ntz'{s} 00:00:00'")
    got = upsert.versions_from_history(df, "doc", ["uf"], "at", lit("1900-01-01"), lit("9999-12-31")).orderBy("nr_versao").collect()
    assert [(r.uf, r.inicio.year, r.fim, r.vigente, r.qtd) for r in got] == [("SP", 1900, t(7), False, 3), ("RJ", 2026, datetime.datetime(9999, 12, 31), True, 1)]


def test_keys(spark):
    df = spark.createDataFrame([("11222333000181",), ("11222333000182",), ("12ABC34501DE35",), (None,), ("x",)], "c string")
    assert [r[0] for r in df.select(keys.cnpj_ok(F.col("c"))).collect()] == [True, False, True, False, False]
    df = spark.createDataFrame([(None, 1), ("", 1)], "a string, b int")
    a, b = [r[0] for r in df.select(keys.row_hash(F.col("a"), F.col("b"))).collect()]
    assert a != b
    a, b = [r[0] for r in df.select(keys.surrogate_key(F.col("a"), F.col("b"))).collect()]
    assert a != b
    wide = spark.createDataFrame([("123456789", 5, None), ("1", 5, "x")], "cnpj_basico string, n int, uf string")
    assert [r[0] for r in wide.select(keys.too_long({"cnpj_basico": 8, "n": 0, "uf": 2, "nada": 1}, wide.schema)).collect()] == [True, False]


def test_roman():
    assert all(text.from_roman(text.to_roman(n)) == n for n in range(1, 400)) and text.from_roman("IIX") is None and text.from_roman("") is None


def test_rules():
    assert [quality.freshness(h, 24, 48) for h in (1, 30, 50, None)] == ["pass", "warn", "fail", "fail"]
    assert [quality.threshold(v, 1, 3) for v in (0, 1, 3, 4, None)] == ["fail", "pass", "pass", "fail", "fail"]
    assert quality.reconciliation(100, 101, 1) == "pass" and quality.reconciliation(0, 1, 1) == "fail" and quality.reconciliation(None, 1, 1) == "fail"
    assert quality.gate({"a": 0.5, "b": 0.9, "c": 1.0}, {"a": 0.6, "b": 0.5}, 10) == ["c"]
    assert quality.gate({"a": 0.4}, {"a": 0.6}, 10) == ["a"]


def test_check_runner(spark):
    def boom(s):
        raise RuntimeError("x")

    checks = [quality.Check("e", boom, quality.threshold), quality.Check("lento", lambda s: (s.range(1).select(F.expr("java_method('java.lang.Thread', 'sleep', 1L)")).count(),), quality.threshold, heavy=True)]
    checks += [
        quality.Check("sem tabela", lambda s: (s.table("nao_existe").count(),), quality.threshold),
        quality.Check("suspenso", lambda s: (1,), quality.threshold, suspended=True),
        quality.Check("aviso", lambda s: (9,), lambda v: quality.threshold(v, high=0), severity="warn"),
        quality.Check("depende", lambda s: (1,), quality.threshold, requires="aviso"),
    ]
    got = {r["check"]: r["status"] for r in quality.run_checks(spark, checks, with_heavy=False)}
    assert got == {"e": "error", "lento": "skipped", "sem tabela": "skipped", "suspenso": "skipped", "aviso": "warn", "depende": "skipped"}


def test_zip_source(spark, tmp_path):
    for n, lines in (("A1.zip", ["1;x;y", "", '2;"a;b";ç;d;e', "3"]), ("B2.zip", ["9;z;w"] * 5)):
        with zipfile.ZipFile(tmp_path / n, "w") as z:
            z.writestr("dados", "\r\n".join(lines).encode("latin-1"))
    spark.dataSource.register(files.ZipCsv)
    df = spark.read.format("zipcsv").option("width", "3").option("maxRows", "3").load(str(tmp_path))
    assert df.rdd.getNumPartitions() == 2
    assert rows(df) == [("A1.zip", "1", "x", "y"), ("A1.zip", "2", "a;b", "ç d e"), ("A1.zip", "3", "", "")] + [("B2.zip", "9", "z", "w")] * 3
    b = io.BytesIO((tmp_path / "A1.zip").read_bytes())
    assert len(list(files.zip_rows(b, 3))) == 3


def test_contract_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿Estado - Sigla; Valor de Venda ;X\nSP;6,29;1\nRJ;6,\xff;2\n".encode("latin-1", "replace").replace(b"?Estado", b"\xef\xbb\xbfEstado"))
    df = files.read_contract_csv(spark, str(tmp_path / "a.csv"), ["estado_sigla", "valor_de_venda"])
    assert [r.lossy for r in df.collect()] == [False, True] and df.columns == ["estado_sigla", "valor_de_venda", "lossy"]
    with pytest.raises(files.ContractError):
        files.read_contract_csv(spark, str(tmp_path / "a.csv"), ["falta"])


def test_unlike_headers_in_one_folder(spark, tmp_path):
    write = lambda n, text: (tmp_path / n).write_text(text, encoding="utf-8")
    write("a.csv", "estado;valor\nSP;6,2\n")
    write("b.csv", 'valor;"Estado"\n7,1;RJ\n"a;b";MG\n')
    write("c.csv", "valor;outra\n1;2\n")
    write("d.csv", "x;estado;y;valor\n0;BA;0;9\n")
    write("e.csv", "")
    write("f.csv", "estado;valor;valor\n1;2;3\n")
    df, refused = files.land_csv(spark, [p for p, _ in files.list_files(spark, str(tmp_path))], ["estado", "valor"])
    assert rows(df.select("arquivo", "estado", "valor")) == [("a.csv", "SP", "6,2"), ("b.csv", "MG", "a;b"), ("b.csv", "RJ", "7,1"), ("d.csv", "BA", "9")]
    assert [(p.rpartition("/")[2], why) for p, why in refused] == [("c.csv", "falta estado"), ("e.csv", "falta estado; falta valor"), ("f.csv", "repete valor")]
    assert files.land_csv(spark, [], ["a"]) == (None, [])
    with pytest.raises(files.ContractError):
        files.read_contract_csv(spark, str(tmp_path), ["estado", "valor"])


def test_landing_by_load_key(spark, tmp_path):
    (tmp_path / "mensal" / "2026").mkdir(parents=True)
    (tmp_path / "semana-2026-01-04.csv").write_text("a;b\n1;x\n2;y\n")
    (tmp_path / "mensal" / "2026" / "jan-20260131.csv").write_text("b;a\nz;3\n")
    (tmp_path / "mensal" / "ruim.csv").write_text("a\n9\n")
    table = fresh(spark, "landed")
    keys, refused = files.land(spark, str(tmp_path), ["a", "b"], table)
    assert keys == ["jan-20260131.csv#ref=2026-01-31", "semana-2026-01-04.csv#ref=2026-01-04"] and [why for _, why in refused] == ["falta b"]
    (tmp_path / "semana-2026-01-04.csv").write_text("a;b\n5;w\n")
    assert files.land(spark, str(tmp_path), ["a", "b"], table, {keys[0]})[0] == keys[1:]
    assert rows(spark.read.parquet(table).select("a", "b", "load_key")) == [("3", "z", keys[0]), ("5", "w", keys[1])]


def test_replace_partitions(spark):
    at = fresh(spark, "p")
    df = spark.createDataFrame([(1, 10), (2, 20)], "m int, v int")
    df.write.partitionBy("m").parquet(at)
    files.replace_partitions(spark.createDataFrame([(2, 99)], "m int, v int"), at, ["m"])
    assert rows(spark.read.parquet(at).select("m", "v")) == [(1, 10), (2, 99)]


VOCABULARY = ask.Vocabulary({n: n for n in ("ETANOL", "DIESEL", "DIESEL S10")}, {n: n for n in ("MORRO ALTO", "MORRO ALTO DO NORTE", "SERRINHA")}, {"AZUL": "AZUL"}, datetime.date(2024, 1, 1), datetime.date(2025, 8, 9))


@pytest.mark.parametrize(
    "question,want",
    [
        ("o diesel s10 do morro alto do norte está caro?", dict(product="DIESEL S10", town="MORRO ALTO DO NORTE")),
        ("diesl na serrrinha", dict(product="DIESEL", town="SERRINHA")),  # one letter lost, one doubled
        ("preço no azul", dict(brand="AZUL")),
        ("tenal e morro baixo", {}),
        ("", {}),
    ],
)
def test_names(question, want):
    assert VOCABULARY.names.find(ask.words(question)) == want


@pytest.mark.parametrize(
    "question,want",
    [
        ("Quantas revendas cobram o menor preço médio?", "COUNT"),
        ("média, mínima e máxima", "STATS"),
        ("entre a mais baixa e a mais alta", "STATS"),
        ("onde é mais barato?", "MIN"),
        ("maiores preços", "MAX"),
        ("liste os revendedores da serra", "LISTA"),
        ("um posto qualquer", None),
    ],
)
def test_wishes(question, want):
    assert ask.intent(question) == want


@pytest.mark.parametrize(
    "question,first,last",
    [
        ("desde 2023-02-28", "2023-02-28", "2023-02-28"),
        ("mês 2 de 2024", "2024-02-01", "2024-02-29"),
        ("em 7/2022", "2022-07-01", "2022-07-31"),
        ("Dezembro de 2021", "2021-12-01", "2021-12-31"),
        ("abril passado", "2025-04-01", "2025-04-30"),
        ("no último mês", "2025-08-01", "2025-08-31"),
        ("em 2024-02-31", None, None),
        ("em 13/2024", None, None),
        ("ontem", None, None),
    ],
)
def test_periods(question, first, last):
    day = lambda x: x and datetime.date.fromisoformat(x)
    assert ask.period(question, VOCABULARY.last) == (day(first), day(last))


def test_questions():
    q = ask.read("qual o maior preço do etanol em Serrinha, março de 2025?", VOCABULARY)
    assert (q.product, q.town, q.intent, q.start, q.route) == ("ETANOL", "SERRINHA", "MAX", datetime.date(2025, 3, 1), "sql")
    q = ask.read("e o 98.765.432/0001-10?", VOCABULARY)
    assert (q.cnpj, q.route, q.start) == ("98765432000110", "sql", None)


def test_vocabulary_is_one_pass(spark):
    df = spark.createDataFrame([("A B", "X", None, datetime.date(2025, 1, 2)), ("A B", " ", "Y", datetime.date(2025, 1, 5))], "produto string, municipio string, bandeira string, data_coleta date")
    v = ask.Vocabulary.load(df)
    assert (v.products, v.towns, v.brands, v.first, v.last) == ({"A B": "A B"}, {"X": "X"}, {"Y": "Y"}, datetime.date(2025, 1, 2), datetime.date(2025, 1, 5))


def printed(text):
    """A law's lines; a dot at the margin stands for the printed indentation."""
    return [line.strip().replace(".    ", "    ", 1) for line in text.strip().split("\n")]


@pytest.mark.parametrize(
    "text,ids",
    [
        (
            """.    Art. 21. Fica criado o cadastro de:
            .    I - viveiros;
            .    II - hortos:
            .    a) públicos;
            .    b) privados.
            .    § 1º O cadastro é gratuito.
            .    § 2º Dele constam:
            .    I - o nome.""",
            "art-21 art-21:inc-I art-21:inc-II art-21:inc-II:ali-a art-21:inc-II:ali-b art-21:par-1 art-21:par-2 art-21:par-2:inc-I",
        ),
        (".    Art. 4º Vale o que diz o\n            § 7º da lei anterior.\n            .    Parágrafo único. Nada mais.", "art-4 art-4:par-unico"),  # a reference cut by the line's end
        (".    Art. 8º Passa a vigorar:\n            “Art. 30. Outro.\n            I - alheio.” (NR)\n            .    Art. 9º Revogado.", "art-8 art-9"),  # the quoted law is not this one
        (".    Art. 2º X.\n            .    Art. 2º-B. Y.\n            .    Art. 2º Z.", "art-2 art-2-B art-2#2"),
        ("sem artigo algum", ""),
    ],
)
def test_law_markers(text, ids):
    assert [p.id for p in law.parse(printed(text), "l")] == ["l:" + i for i in ids.split()]


INDEX = law.Index(["l:" + x for x in "art-3 art-3:inc-I art-3:inc-II art-3:par-1 art-3:par-1:inc-II art-8:par-unico art-20:par-4:inc-V:ali-c art-31:inc-VI:ali-b art-31:par-2:inc-I:ali-b art-32 art-33".split()])


@pytest.mark.parametrize(
    "question,route,anchors",
    [
        ("art. 3º, § 1º, II", "sql", ["art-3:par-1:inc-II"]),
        ("o inciso II do art. 3º", "sql", ["art-3:inc-II"]),  # exactly so, before the one in a paragraph
        ("inciso I do caput do art. 3º", "sql", ["art-3:inc-I"]),
        ("alínea c do inciso V do § 4º do art. 20", "sql", ["art-20:par-4:inc-V:ali-c"]),
        ("inciso V do art. 20", "clarify", []),  # the item itself is no provision here
        ("§ único do art. 8º", "sql", ["art-8:par-unico"]),
        ("quem os arts. 32 e 33 obrigam?", "combined", ["art-32", "art-33"]),
        ("a alínea b do art. 31", "clarify", []),  # two of them, neither stated in full
        ("art. 77", "clarify", []),
        ("art. 5º da Constituição", "vector", []),
        ("olá", "vector", []),
    ],
)
def test_citations(question, route, anchors):
    p = law.route(question, INDEX)
    assert (p.route, p.anchors) == (route, ["l:" + a for a in anchors])


def test_wish_and_context():
    assert [law.route(q, INDEX).wish for q in ("o art. 32 foi revogado?", "o que mudou no art. 32", "qual o texto do art. 32", "art. 32", "quando o art. 32 se aplica?")] == ["status", "history", "text", "text", None]
    cited = law.citations("art. 33")[0]
    assert law.route("e esse artigo, foi alterado?", INDEX, cited).anchors == ["l:art-33"]
    assert law.route("bom dia", INDEX, cited).anchors == [] and law.route("e esse?", INDEX).route == "vector"


def test_printings_and_contract(spark):
    text = """    Art. 1º Antes. (Revogado)
    I - velho.
    Art. 1º Agora.
    Art. 2º Só um. (Vetado)
    Art. 3º Um.
    II - fora de ordem.
    Art. 3º Dois. (Revogado)"""
    found = law.provisions(spark.createDataFrame([("d", text), ("e", None)], "d string, t string"), "d", "t")
    kept = rows(law.latest_printing(found).select("dispositivo_id", "parent_id", "texto"))
    assert [k[0] for k in kept] == ["d:art-1", "d:art-2", "d:art-3", "d:art-3:inc-II"] and kept[0][2].endswith("Agora.") and kept[3][1] == "d:art-3"
    assert sorted(law.contract([r.asDict() for r in found.orderBy("linha").collect()])) == [("sequencia", "d:art-3:inc-II"), ("unico", "d:art-1#2"), ("unico", "d:art-3#2")]
    assert law.latest_printing(found.limit(0)).count() == 0


def test_chunks_fit_and_lose_nothing():
    words = lambda n: " ".join(f"p{k}" for k in range(n))
    row = lambda i, kind, parent, n: {"dispositivo_id": i, "parent_id": parent, "tipo": kind, "texto": f"{i} {words(n)}"}
    article = [row("a", "art", None, 20), row("a:inc-I", "inc", "a", 30), row("a:inc-I:ali-a", "ali", "a:inc-I", 90)] + [x for k in range(1, 5) for x in (row(f"a:par-{k}", "par", "a", 40), row(f"a:par-{k}:inc-I", "inc", f"a:par-{k}", 200 if k == 2 else 10))]
    count = lambda t: len(t.split())
    for limit in (60, 90, 150, 400, 2000):
        made = law.chunks(article, "cabeçalho", limit, prefix_words=8, overlap=5, count=count)
        assert all(count(c["texto"]) <= limit for c in made), limit
        assert {i for c in made for i in c["ids"]} == {r["dispositivo_id"] for r in article}
        for r in article:  # every word of every provision stands in some chunk
            assert set(r["texto"].split()) <= {w for c in made if r["dispositivo_id"] in c["ids"] for w in c["texto"].split()}
    assert len(law.chunks(article, "c", 2000, count=count)) == 1


def test_reply_and_budget():
    ok = retrieval.read_reply('texto {"resposta": "sim", "citacoes": ["a", "x", "a"]} fim', {"a"})
    assert (ok["recusou"], ok["citacoes"], ok["invalidas"]) == (False, ["a"], ["x"])
    assert retrieval.read_reply("nada", {"a"})["motivo"] == "formato" and retrieval.read_reply('{"resposta": "s", "citacoes": ["x"]}', {"a"})["motivo"] == "sem citacao"
    kept, dropped = retrieval.assemble([{"art_id": "a", "formas": ["x " * 9]}, {"art_id": "b", "formas": ["x " * 50, "x x"]}], ["b"], 5, lambda t: len(t.split()))
    assert [k["art_id"] for k in kept] == ["b"] and dropped == ["a"]
    assert retrieval.pages("a b c", 2) == ["a b", "c"] and retrieval.pages("") == [""]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_cells_recall(spark, folder):
    import os

    import numpy as np

    from garimpo.operators import ivf

    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    v = spark.read.parquet(f"{folder}/embeddings.parquet")
    c = ivf.fit(v, "embedding")
    q = v.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("v"))
    indexed = ivf.index(v, "embedding", c)
    assert indexed.count() == v.count()
    got = {}
    for r in ivf.search(indexed, "vec_id", "embedding", q, c).collect():
        got.setdefault(r.q, set()).add(r.id)
    rows_ = v.collect()
    ids, x = np.array([r.vec_id for r in rows_]), np.array([r.embedding for r in rows_], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = total = 0
    for k in np.flatnonzero(ids % 50 == 0):
        want = set(ids[np.lexsort((ids, -(x @ x[k])))[:10]].tolist())
        hit, total = hit + len(want & got[ids[k]]), total + len(want)
    assert hit / total >= 0.9, hit / total


def test_cells_edges(spark):
    from garimpo.operators import ivf

    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [1.0, 0.0])], "vec_id int, embedding array<float>")
    c = ivf.fit(v, "embedding", cells=8)
    found = ivf.search(ivf.index(v, "embedding", c), "vec_id", "embedding", v.filter("vec_id = 1").select(F.col("vec_id").alias("q"), F.col("embedding").alias("v")), c, k=2)
    assert [(r.id, r.posicao) for r in found.orderBy("posicao").collect()] == [(1, 1), (4, 2)]
    assert ivf.index(v.limit(0), "embedding", ivf.fit(v.limit(0), "embedding")).count() == 0


def test_top_k_many_in_blocks(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 1.0]), (5, [1.0, 0.0])], "i int, e array<float>")
    q = v.select(F.col("i").alias("q"), F.col("e").alias("v"))
    want = {1: [5, 2], 2: [1, 5], 4: [2, 1], 5: [1, 2]}
    for block in (1, 2, 100):
        got = {}
        for r in retrieval.top_k_many(v, "e", "i", q, 2, block).orderBy("posicao").collect():
            got.setdefault(r.q, []).append(r.id)
        assert got == want
    assert retrieval.top_k_many(v, "e", "i", q.limit(0), 2).count() == 0


def test_matrix_levels(spark):
    from garimpo.plans import serving

    day = datetime.date(2026, 3, 1)
    data = [
        ("SP", "A", "CENTRO", "P1", "X", "1", "R 1", "GASOLINA", day, 6.0),
        ("SP", "A", "CENTRO", "P1", "X", "1", "R 1", "DIESEL S10", day + datetime.timedelta(1), 7.0),
        ("SP", "A", None, "P2", "X", "2", "R 2", "GASOLINA", day, 5.0),
        ("SP", "A", None, "P2", "X", "2", "R 2", "QUEROSENE", day, 4.0),
        ("SP", "B", "SUL", "P3", "X", "3", "R 3", "GLP", day, 110.0),
        ("SP", "B", "SUL", "P3", "X", "3", "R 3", "GASOLINA C ESPECIAL", day, 8.0),
    ]
    df = spark.createDataFrame(data, "uf string, municipio string, bairro string, revenda string, bandeira string, cnpj string, endereco string, produto string, data_coleta date, valor_venda double")
    state = serving.level_matrix(df, "estado").collect()
    assert [(r.uf, r.qtd_postos, r.ultima_coleta, r.GASOLINA, r["DIESEL S10"], r.GLP, r["GASOLINA C ESPECIAL"], r.outros) for r in state] == [("SP", 3, day + datetime.timedelta(1), 5.5, 7.0, 110.0, 8.0, [("QUEROSENE", 4.0)])]
    assert [(r.municipio, r.GASOLINA) for r in serving.level_matrix(df, "cidade").collect()] == [("A", 5.5), ("B", None)]
    assert [(r.bairro, r.qtd_postos, len(r.outros)) for r in serving.level_matrix(df, "bairro").collect()] == [(None, 1, 1), ("CENTRO", 1, 0), ("SUL", 1, 0)]
    assert [(r.revenda, r.vs_media_cidade) for r in serving.level_matrix(df, "posto").collect()] == [("P2", -9.090909), ("P1", 9.090909), ("P3", None)]
    assert [(r.revenda, r.vs_media_cidade) for r in serving.level_matrix(df, "posto", "GLP").collect()] == [("P3", 0.0), ("P1", None), ("P2", None)]
    assert serving.level_matrix(df.limit(0), "posto").count() == 0


def test_xpath_takes_cut_documents(spark, tmp_path):
    """Documents cut off behind a tag that ends in NFe> keep their row; what stands behind the last tag drops it, as in SQL."""
    import oracle

    from garimpo.plans import registry

    head = '<nfeProc><NFe><infNFe Id="NFe1"><ide><natOp>{}</natOp></ide><det nItem="1"/><det nItem="2"/></infNFe></NFe>'
    texts = {
        "whole": head.format("VENDA") + "<protNFe/></nfeProc>",
        "prefix": '<n:NFe xmlns:n="u"><n:natOp>VENDA</n:natOp><n:det nItem="1"/></n:NFe>',
        "protNFe": head.format("VENDA") + "<protNFe>",
        "infNFe": head.format("")[: -len("</NFe>")],
        "root": "<NFe>",
        "in the name": "<NFe><natOp>VENDA</NFe>",
        "two roots": "<NFe></NFe><NFe></NFe>",
        "entities": "<NFe><natOp>A &amp; B & C\n\u0000</natOp></NFe>",
        "line behind": "<NFe></NFe>\n",
        "space behind": "<NFe></NFe> ",
        "cut": head.format("VENDA") + "<protN",
        "blank": " ",
        "null": None,
    }
    spark.createDataFrame([(1, k, v) for k, v in texts.items()], "lote_id bigint, arquivo string, conteudo string").write.parquet(f"{tmp_path}/nfe_xml.parquet")
    df = registry.queries()["f30_xpath"](spark, str(tmp_path))
    assert oracle.compare(df, oracle.connect(str(tmp_path)), registry.oracle_sql()["f30_xpath"]) is None
    got = {r.arquivo: (r.natureza, r.itens) for r in df.collect()}
    assert got["protNFe"] == got["whole"] == ("VENDA", 2) and got["infNFe"] == (None, 2) and got["in the name"] == ("VENDA", 0)
    assert sorted(got) == sorted([*texts][:8])
