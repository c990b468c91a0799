"""SQL for the core's p-queries, where SQL can say the same over whole tables."""

from __future__ import annotations

from garimpo.plans.problems import GROUP_FIELDS, REFERENCES

ORACLES: dict[str, str] = {}

WHOLE = "(select lote_id, arquivo, conteudo as x from nfe_xml where regexp_matches(rtrim(conteudo, ' \n\r\t'), '(nfeProc|NFe)>$'))"


def _children(source: str, tag: str, keys: str, ordinal: str) -> str:
    """Elements ``tag`` in the text x of each row of source, numbered from 1."""
    found = f"regexp_extract_all(x, '(?s)<(?:n:)?{tag}(?: [^>]*)?>.*?</(?:n:)?{tag}>')"
    return f"(select {keys}, unnest(range(1, len({found}) + 1)) as {ordinal}, unnest({found}) as x from {source})"


def _rows(source: str, group: str, ordinals: list[str]) -> str:
    three = [*ordinals, "0", "0", "0"][:3]
    return f"select lote_id, arquivo, '{group}' as grupo, " + ", ".join(f"cast({o} as int) as ordem{k}" for k, o in enumerate(three, 1)) + f" from {source}"


_K = "lote_id, arquivo"
_det = _children(WHOLE, "det", _K, "a")
_di = _children(_det, "DI", f"{_K}, a", "b")
_vol = _children(WHOLE, "vol", _K, "a")
_vols = _children(_vol, "lacres", f"{_K}, a", "b")
# group -> (source of its elements' texts x, ordinals)
_GROUPS = {
    "det": (_det, ["a"]),
    "rastro": (_children(_det, "rastro", f"{_K}, a", "b"), ["a", "b"]),
    "di": (_di, ["a", "b"]),
    "adi": (_children(_di, "adi", f"{_K}, a, b", "c"), ["a", "b", "c"]),
    "nfref": (_children(WHOLE, "NFref", _K, "a"), ["a"]),
    "dup": (_children(WHOLE, "dup", _K, "a"), ["a"]),
    "detpag": (_children(WHOLE, "detPag", _K, "a"), ["a"]),
    "vol": (_vol, ["a"]),
    "lacres": (_vols, ["a", "b"]),
}
ORACLES["p1_found"] = " union all ".join(_rows(source, group, ordinals) for group, (source, ordinals) in _GROUPS.items())


def _value(path: str) -> str:
    """The first value of a field in the text x: an attribute of the element itself, or an element's text."""
    name = path.rpartition(".")[2]
    if name.startswith("@"):
        return f"""regexp_extract(x, '^<[^>]*?\\b{name[1:]}\\s*=\\s*["'']([^"'']*)["'']', 1)"""
    inner = f"regexp_extract(x, '(?s)<(?:n:)?{name}>(?:<!\\[CDATA\\[)?(.*?)(?:\\]\\]>)?</(?:n:)?{name}>', 1)"
    for sign, entity in (("<", "lt"), (">", "gt"), ('"', "quot"), ("''", "apos"), ("&", "amp")):
        inner = f"replace({inner}, '&{entity};', '{sign}')"
    return f"trim({inner}, ' \n\r\t')"


ORACLES["p1_fields"] = "select * from (" + " union all ".join(
    f"select lote_id, arquivo, '{g}' as grupo, " + ", ".join(f"cast({o} as int) as ordem{k}" for k, o in enumerate([*ordinals, "0", "0", "0"][:3], 1)) + f", '{c}' as campo, {_value(path)} as valor from {source}" for g, (source, ordinals) in _GROUPS.items() for c, path in GROUP_FIELDS[g].items()
) + ") where valor <> ''"
# texts without prefixes, comments, line breaks and blanks between tags stand for the objects
_BARE = "regexp_replace(regexp_replace(regexp_replace(x, '(?s)<!--.*?-->', '', 'g'), '<(/?)n:', '<\\1', 'g'), '>\\s+<', '><', 'g')"
ORACLES["p1_reuse"] = " union all ".join(f"select '{g}' as grupo, count(*) as objetos, cast(sum(n) as bigint) as usos, max(n) as mais_usos from (select {_BARE} as t, count(*) as n from {source} group by 1) having count(*) > 0" for g, (source, _) in _GROUPS.items())
ORACLES["p1_rejects"] = "select lote_id, arquivo from nfe_xml where not coalesce(regexp_matches(rtrim(conteudo, ' \n\r\t'), '(nfeProc|NFe)>$'), false)"


def _number(c: str) -> str:
    d = f"regexp_replace(cast({c} as varchar), '[^0-9]', '', 'g')"
    return f"case when {d} = '' then null when ltrim({d}, '0') = '' then '0' else ltrim({d}, '0') end"


EMPRESAS_OK = (
    "coalesce(regexp_full_match(trim(cnpj_basico), '[0-9]{1,8}'), false) and (natureza_juridica is null or trim(natureza_juridica) = '' or regexp_full_match(trim(natureza_juridica), '[0-9]+|[0-9]+-[0-9]')) "
    "and (qualificacao_responsavel is null or trim(qualificacao_responsavel) = '' or regexp_full_match(trim(qualificacao_responsavel), '[0-9]+'))"
)
_PARENTS = f"(select 'empresas' as dominio, referencia_mes as m, {_number('cnpj_basico')} as k from rfb_empresas where {EMPRESAS_OK} union select dominio, referencia_mes, {_number('codigo')} from rfb_dominios)"
ORPHANS = " union all ".join(
    f"select '{t}' as tabela, '{c}' as campo, referencia_mes, linha_id, {_number(c)} as chave from {t} where {_number(c)} is not null{' and ' + EMPRESAS_OK if t == 'rfb_empresas' else ''} and ({_number(c)}, referencia_mes) not in (select (k, m) from {_PARENTS} where dominio = '{p}' and k is not null)"
    for t, fields in REFERENCES.items()
    for c, p in fields.items()
)
ORACLES["p2_found"] = f"select tabela, campo, referencia_mes, linha_id from ({ORPHANS})"
ORACLES["p2_snapshot"] = f"select tabela, campo, referencia_mes, count(*) as orfaos, count(distinct chave) as chaves from ({ORPHANS}) group by 1, 2, 3"

# a row is an orphan after each load from its own on, until the first load that lists its key
_LOAD = "cast(strftime(_inserted_at, '%Y%m') as int)"
_FIRST = f"(select dominio, m, k, min(c) as c from (select 'empresas' as dominio, referencia_mes as m, {_number('cnpj_basico')} as k, {_LOAD} as c from rfb_empresas where {EMPRESAS_OK} union all select dominio, referencia_mes, {_number('codigo')}, {_LOAD} from rfb_dominios) where k is not null group by 1, 2, 3)"
_ASKED = " union all ".join(f"select '{t}' as tabela, '{c}' as campo, referencia_mes, '{p}' as dominio, {_number(c)} as chave, {_LOAD} as c from {t} where {_number(c)} is not null{' and ' + EMPRESAS_OK if t == 'rfb_empresas' else ''}" for t, fields in REFERENCES.items() for c, p in fields.items())
_LOADS = " union ".join(f"select {_LOAD} as carga from {t}" for t in ("rfb_empresas", "rfb_dominios", "rfb_estabelecimentos", "rfb_socios"))
ORACLES["p2_history"] = (
    f"select carga, tabela, campo, referencia_mes, count(*) as orfaos, count(distinct chave) as chaves from (select a.*, f.c as chegou from ({_ASKED}) a left join {_FIRST} f on f.dominio = a.dominio and f.k = a.chave and f.m is not distinct from a.referencia_mes) r join ({_LOADS}) l on l.carga >= r.c "
    "where r.chegou is null or r.chegou > l.carga group by 1, 2, 3, 4"
)

_MESSAGES = "(select lote_id, arquivo, regexp_extract(conteudo, 'Id=\"NFe([0-9]{44})\"', 1) as chave, row_number() over (partition by regexp_extract(conteudo, 'Id=\"NFe([0-9]{44})\"', 1) order by carregado_em desc, lote_id desc, arquivo desc) as rn from nfe_xml)"
ORACLES["p3_found"] = f"select lote_id, arquivo from {_MESSAGES} where rn > 1"
ORACLES["p3_kept"] = f"select chave, lote_id, arquivo from {_MESSAGES} where rn = 1"

_FIELD = '(?:"(?:[^"]|"")*"|[^";]*)'


def _text(n: int) -> str:
    f = f"regexp_extract(l, '^(?:{_FIELD};){{{n}}}({_FIELD})(?:;|$)', 1)"
    return f"trim(case when {f} like '\"%' then replace(substr({f}, 2, length({f}) - 2), '\"\"', '\"') else {f} end)"


def _price_ok(c: str) -> str:
    return f"({c} is null or trim({c}) = '' or regexp_full_match(trim({c}), '[+-]?[0-9]+([.,][0-9]+)?'))"


def _date_ok(c: str) -> str:
    return f"coalesce(regexp_full_match(trim({c}), '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') and try_strptime(trim({c}), '%d/%m/%Y') is not null, false)"


_LINES = "(select linha_id, regexp_replace(linha, '\\r+$', '') as l from anp_csv_bruto where linha is not null and trim(regexp_replace(linha, '[ \\t\\r]+', '', 'g')) <> '')"
_LINE_OK = f"regexp_full_match(l, '(?:{_FIELD};){{15}}{_FIELD}') and {_date_ok(_text(11))} and {_price_ok(_text(12))}"
ORACLES["p6_found"] = (
    f"select 'anp_landing_semanal' as tabela, linha_id from anp_landing_semanal where not ({_price_ok('valor_de_venda')} and {_date_ok('data_da_coleta')}) "
    f"union all select 'rfb_empresas', linha_id from rfb_empresas where not ({EMPRESAS_OK}) union all select 'anp_csv_bruto', linha_id from {_LINES} where not ({_LINE_OK})"
)
ORACLES["p6_displaced"] = f"select referencia_mes, count(*) filter (where s and r) as apanhadas, count(*) filter (where not s and r) as perdidas, count(*) filter (where s and not r) as acusadas, count(*) as linhas from (select referencia_mes, coalesce(_suspeita_deslocamento, false) as s, not ({EMPRESAS_OK}) as r from rfb_empresas) group by 1"
ORACLES["p6_loaded"] = (
    f"select linha_id, case when length(regexp_replace({_text(4)}, '[^0-9]', '', 'g')) = 14 then regexp_replace({_text(4)}, '[^0-9]', '', 'g') end as cnpj, {_text(10)} as produto, cast(strptime({_text(11)}, '%d/%m/%Y') as date) as dia, "
    f"try_cast(replace({_text(12)}, ',', '.') as double) as valor from {_LINES} where {_LINE_OK}"
)

# the usual price told another way: the median of the five dates before and after
ORACLES["p4_found"] = f"""with r as (select linha_id, case when length(regexp_replace(cnpj_da_revenda, '[^0-9]', '', 'g')) = 14 then regexp_replace(cnpj_da_revenda, '[^0-9]', '', 'g') end as k, upper(trim(produto)) as p,
    cast(strptime(trim(data_da_coleta), '%d/%m/%Y') as date) as d, cast(replace(nullif(trim(valor_de_venda), ''), ',', '.') as double) as v from anp_landing_semanal where {_price_ok('valor_de_venda')} and {_date_ok('data_da_coleta')} and nullif(trim(valor_de_venda), '') is not null),
    g as (select k, p, d, median(v) as m, min(v) as lo, max(v) as hi from r where k is not null and p is not null group by 1, 2, 3),
    u as (select *, median(m) over (partition by k, p order by d rows between 5 preceding and 5 following exclude current row) as usual, count(*) over (partition by k, p) as n,
      row_number() over (partition by k, p order by d) as i, case when lo = hi and lag(lo) over (partition by k, p order by d) = lo and lag(hi) over (partition by k, p order by d) = hi then 0 else 1 end as novo from g),
    s as (select *, sum(novo) over (partition by k, p order by d) as grupo from u),
    t as (select *, count(*) over (partition by k, p, grupo) as corrida from s)
    select linha_id from r where v <= 0 union select linha_id from r join t using (k, p, d) where v > 0 and ((n >= 4 and abs(v / usual - 1) > 0.3) or (lo = hi and corrida >= 6))"""
