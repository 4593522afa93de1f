"""DuckDB SQL for the registered queries. Written against the semantics, not the Spark code."""

from __future__ import annotations

from kinlink.operators.lsh import PRIME, MinHashConfig, hash_parameters
from kinlink.sources.generate import DAYS, FIRST_NAMES, LAST_NAMES
from kinlink.schema import STATUSES
from workload.persons import PERSONS_SQL, gaps_sql  # noqa: F401

PAIR_COLUMNS = """a.nr_documento AS nr_documento_1, a.nome_completo AS nome_completo_1,
    a.data_nascimento AS data_nascimento_1, a.status AS status_1,
    b.nr_documento AS nr_documento_2, b.nome_completo AS nome_completo_2,
    b.data_nascimento AS data_nascimento_2, b.status AS status_2"""
MATCH = """nr_documento_1, nome_completo_1, data_nascimento_1, status_1, nr_documento_2,
    nome_completo_2, data_nascimento_2, status_2, similarity_score, name_lev_score,
    name_jaro_score, date_score"""


def soundex(name: str) -> str:
    """Soundex in SQL: letters to digits, runs collapsed, vowels separate, H and W do not."""
    kept = (f"left(upper({name}), 1) || regexp_replace(regexp_replace(substr(upper({name}), 2), "
            f"'[^A-Z]', 'A', 'g'), '[HW]', '', 'g')")
    digits = f"translate({kept}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    for d in "123456":
        digits = f"regexp_replace({digits}, '{d}+', '{d}', 'g')"
    tail = f"replace(substr({digits}, 2), '0', '')"
    return f"rpad(left(left(upper({name}), 1) || {tail}, 4), 4, '0')"


def prefix(t: str) -> str:
    return f"concat_ws('_', substr({t}.nome_completo, 1, 3), substr({t}.data_nascimento, 1, 4))"


def phonetic(t: str) -> str:
    return f"concat_ws('_', {soundex(t + '.nome_completo')}, substr({t}.data_nascimento, 1, 7))"


def lev(x: str, y: str) -> str:
    return (f"CASE WHEN length({x}) > 0 AND length({y}) > 0 THEN 1.0::DOUBLE - "
            f"levenshtein(lower({x}), lower({y}))::DOUBLE / greatest(length({x}), length({y})) "
            f"ELSE 0.0::DOUBLE END")


def jaro(x: str, y: str) -> str:
    return (f"CASE WHEN length({x}) > 0 AND length({y}) > 0 THEN "
            f"jaro_winkler_similarity(lower({x}), lower({y})) ELSE 0.0::DOUBLE END")


def combined(x: str, y: str) -> str:
    return (f"round(CASE WHEN NOT coalesce(length({x}) > 0 AND length({y}) > 0, FALSE) THEN 0.0::DOUBLE "
            f"WHEN lower({x}) = lower({y}) THEN 1.0::DOUBLE "
            f"ELSE ({lev(x, y)}) * 0.4::DOUBLE + ({jaro(x, y)}) * 0.6::DOUBLE END, 9)")


def date_score(x: str, y: str) -> str:
    return (f"CASE WHEN NOT coalesce(length({x}) > 0 AND length({y}) > 0, FALSE) THEN 0.0::DOUBLE "
            f"WHEN {x} = {y} THEN 1.0::DOUBLE "
            f"WHEN substr({x}, 1, 7) = substr({y}, 1, 7) THEN 0.8::DOUBLE "
            f"WHEN substr({x}, 1, 4) = substr({y}, 1, 4) THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END")


def birth_year(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') "
            f"THEN year(try_cast({x} AS DATE)) END")


AGE_GAP = f"abs({birth_year('a.data_nascimento')} - {birth_year('b.data_nascimento')}) <= 5"


def scored(on: str, a: str = "a", b: str = "b") -> str:
    """CTEs `cand` and `scored`: pairs of two person CTEs under a join condition."""
    n1, n2, d1, d2 = "nome_completo_1", "nome_completo_2", "data_nascimento_1", "data_nascimento_2"
    return f"""
cand AS (SELECT {PAIR_COLUMNS} FROM {a} AS a JOIN {b} AS b ON {on}),
parts AS (SELECT *, {lev(n1, n2)} AS s_lev, {jaro(n1, n2)} AS s_jaro,
    CASE WHEN length({n1}) > 0 AND length({n2}) > 0 AND {soundex(n1)} = {soundex(n2)}
         THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS name_soundex_score,
    {date_score(d1, d2)} AS date_score,
    (nr_documento_1 = nr_documento_2)::DOUBLE AS doc_match FROM cand),
scored AS (SELECT *, round(s_lev, 9) AS name_lev_score, round(s_jaro, 9) AS name_jaro_score,
    round(s_lev * 0.25::DOUBLE + s_jaro * 0.25::DOUBLE + name_soundex_score * 0.15::DOUBLE
        + date_score * 0.25::DOUBLE + doc_match * 0.10::DOUBLE, 9) AS similarity_score FROM parts)"""


def matches(on: str, threshold: float = 0.7, a: str = "a", b: str = "b") -> str:
    return f"{scored(on, a, b)},\nm AS (SELECT {MATCH} FROM scored WHERE similarity_score >= {threshold}::DOUBLE)"


BY_PREFIX = f"{prefix('a')} = {prefix('b')}"
BY_PHONETIC = f"{phonetic('a')} = {phonetic('b')}"


def base(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join([PERSONS_SQL.strip(), *[c.strip() for c in ctes]])


def _age(x: str, as_of: str) -> str:
    return (f"coalesce(year({as_of}) - year({x}) - CASE WHEN strftime({as_of}, '%m%d') >= "
            f"strftime({x}, '%m%d') THEN 0 ELSE 1 END, 0)::INTEGER")


def served(as_of: str = "2025-06-30") -> str:
    """CTE `served` over `m`."""
    day = f"DATE '{as_of}'"
    return f"""
dated AS (SELECT *, try_cast(data_nascimento_1 AS DATE) AS b1, try_cast(data_nascimento_2 AS DATE) AS b2 FROM m),
aged AS (SELECT *, {_age('b1', day)} AS idade_1, {_age('b2', day)} AS idade_2 FROM dated),
served AS (SELECT nr_documento_1 || '_' || nr_documento_2 AS match_id, nome_completo_1, nome_completo_2,
    b1 AS data_nascimento_1, b2 AS data_nascimento_2, nr_documento_1, nr_documento_2, similarity_score,
    name_lev_score AS levenshtein_sim, name_jaro_score AS jaro_winkler_sim, idade_1, idade_2,
    abs(idade_1 - idade_2) AS idade_diff FROM aged)"""


SERVED = base(matches(BY_PREFIX), served())

# --- name analysis ----------------------------------------------------------------------------


def tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z0-9_]+')"


def fuzzy(x: str, words: list[tuple[str, int]]) -> str:
    near = " OR ".join(f"damerau_levenshtein(t, '{w}') <= {k}" for w, k in words)
    return f"len(list_filter({tokens(x)}, lambda t: {near})) > 0"


def phrase(x: str, text: str) -> str:
    return f"contains(' ' || array_to_string({tokens(x)}, ' ') || ' ', ' {text} ')"


_NAMES = """,
names AS (SELECT match_id, similarity_score, ' ' || array_to_string(%s, ' ') || ' ' AS words FROM served
    UNION ALL SELECT match_id, similarity_score, ' ' || array_to_string(%s, ' ') || ' ' FROM served)""" % (tokens("nome_completo_1"), tokens("nome_completo_2"))

#: Words of the names of table B, words of the served names, and which of the first are near which of the second.
INDEXED_WORDS = _NAMES + """,
places AS (SELECT DISTINCT match_id, similarity_score, unnest(string_split(trim(words), ' ')) AS token FROM names),
asked AS (SELECT DISTINCT nr_documento AS query_id, unnest(%s) AS word FROM b),
near AS (SELECT word, token FROM (SELECT DISTINCT word FROM asked), (SELECT DISTINCT token FROM places)
    WHERE damerau_levenshtein(token, word) <= CASE WHEN length(word) <= 2 THEN 0 WHEN length(word) <= 5 THEN 1 ELSE 2 END)""" % tokens("nome_completo")

INDEXED_PHRASES = _NAMES + r""",
asked AS (SELECT nr_documento AS query_id, ' ' || lower(regexp_extract(nome_completo, '(\w+ \w+)$', 1)) || ' ' AS phrase FROM b
    WHERE regexp_matches(nome_completo, '\w+ \w+$'))"""

# --- file snapshots derived from orders -------------------------------------------------------

SNAPSHOTS = """
f AS (SELECT o_orderkey AS k, 'dataset' || (o_orderkey % 3) AS dataset_id,
    'part-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.parquet' AS path,
    CAST(round(o_totalprice * 100) AS BIGINT) AS size,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS last_modified,
    md5(CAST(o_orderkey AS VARCHAR)) AS etag FROM orders),
cur AS (SELECT dataset_id, path, size, last_modified, etag FROM f WHERE k % 3 = 2 OR k % 19 <> 0),
prev AS (SELECT dataset_id, path, size, last_modified,
    CASE WHEN k % 3 <> 2 AND k % 13 = 0 THEN md5(CAST(k AS VARCHAR) || 'x') ELSE etag END AS etag
    FROM f WHERE k % 3 = 2 OR k % 17 <> 0)"""


def fingerprint(source: str, target: str) -> str:
    words = ", ".join(f"sum(('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT) AS w{i}" for i in range(8))
    names = " || '-' || ".join(f"CAST(w{i} AS VARCHAR)" for i in range(8))
    return f"""
{target}_h AS (SELECT dataset_id, sha256(path || '|' || size || '|' || last_modified || '|' || etag) AS h FROM {source}),
{target}_w AS (SELECT dataset_id, count(*) AS file_count, {words} FROM {target}_h GROUP BY dataset_id),
{target} AS (SELECT dataset_id, sha256(CAST(file_count AS VARCHAR) || '-' || {names}) AS metadata_hash,
    file_count FROM {target}_w)"""


# --- document check digits --------------------------------------------------------------------

def check_digits(doc: str) -> str:
    """The two check digits of the first nine digits, as text."""
    digit = lambda i: f"substr({doc}, {i + 1}, 1)::INTEGER"
    first = " + ".join(f"{10 - i} * {digit(i)}" for i in range(9))
    d1 = f"(CASE WHEN 11 - ({first}) % 11 >= 10 THEN 0 ELSE 11 - ({first}) % 11 END)"
    second = " + ".join(f"{11 - i} * {digit(i)}" for i in range(9)) + f" + 2 * {d1}"
    d2 = f"(CASE WHEN 11 - ({second}) % 11 >= 10 THEN 0 ELSE 11 - ({second}) % 11 END)"
    return f"({d1} || '' || {d2})"


CPF = f"""
cc AS (SELECT c_custkey AS k, lpad(CAST((c_custkey * 104729 + 12345) % 100000000000 AS VARCHAR), 11, '0') AS raw FROM customer),
cd AS (SELECT k, left(raw, 9) AS nine, {check_digits('raw')} AS chk FROM cc),
docs AS (SELECT k, nine || CASE WHEN k % 2 = 0 THEN chk
    ELSE left(chk, 1) || CAST((right(chk, 1)::INTEGER + 1) % 10 AS VARCHAR) END AS doc FROM cd),
cpf AS (SELECT a.nome_completo, a.data_nascimento, docs.doc AS nr_documento, a.status
    FROM docs JOIN a ON a.nr_documento = lpad(CAST((k * 104729 + 12345) % 100000000000 AS VARCHAR), 11, '0'))"""


def cpf_valid(doc: str) -> str:
    return (f"coalesce(regexp_full_match({doc}, '[0-9]{{11}}') AND "
            f"right({doc}, 2) = {check_digits(doc)}, FALSE)")


def quality_profile() -> str:
    columns = ["nome_completo", "data_nascimento", "nr_documento", "status"]
    rows = ["SELECT 'rows' AS measure, count(*) AS value FROM q"]
    for c in columns:
        rows.append(f"SELECT '{c}_null', count(*) FROM q WHERE {c} IS NULL")
        rows.append(f"SELECT '{c}_empty', count(*) FROM q WHERE {c} = ''")
    rows.append("SELECT 'birth_date_invalid', count(*) FROM q WHERE data_nascimento <> '' "
                "AND try_cast(data_nascimento AS DATE) IS NULL")
    rows.append(f"SELECT 'document_invalid', count(*) FROM q WHERE nr_documento <> '' "
                f"AND NOT {cpf_valid('nr_documento')}")
    rows.append("SELECT 'status_unknown', count(*) FROM q WHERE status <> '' AND status NOT IN "
                "('Ativo', 'Inativo', 'Pendente', 'Bloqueado')")
    rows.append("SELECT 'document_repeated', count(*) FROM (SELECT nr_documento FROM q WHERE "
                "nr_documento <> '' GROUP BY nr_documento HAVING count(*) > 1)")
    return base(CPF, gaps_sql("cpf", "q")) + "\n" + "\nUNION ALL ".join(rows)


# --- MinHash ----------------------------------------------------------------------------------

def lsh(cfg: MinHashConfig) -> str:
    parameters = hash_parameters(cfg)
    mins = [f"CAST(list_min(list_transform(codes, lambda x: (x * {a} + {b}) % {PRIME})) AS VARCHAR)" for a, b in parameters]
    bands = [" || '-' || ".join(mins[i * cfg.rows:(i + 1) * cfg.rows]) for i in range(cfg.bands)]
    shingle = lambda side: f"""
s{side} AS (SELECT n, list_distinct(list_transform(range(1, length(n) - 1), lambda i: substr(lower(n), i, 3))) AS g
    FROM (SELECT DISTINCT nome_completo AS n FROM {side}) WHERE length(n) >= 3),
c{side} AS (SELECT n, g, list_transform(g, lambda t: ('0x' || substr(md5(t), 1, 8))::BIGINT % {PRIME}) AS codes FROM s{side}),
h{side} AS (SELECT n, g, [{", ".join(bands)}] AS keys FROM c{side})"""
    same = " OR ".join(f"x.keys[{i + 1}] = y.keys[{i + 1}]" for i in range(cfg.bands))
    distance = ("1 - len(list_intersect(x.g, y.g))::DOUBLE / "
                "(len(x.g) + len(y.g) - len(list_intersect(x.g, y.g)))")
    return base(shingle("a"), shingle("b")) + f""",
near AS (SELECT x.n AS n1, y.n AS n2, {distance} AS distance FROM ha x JOIN hb y ON {same})
SELECT {PAIR_COLUMNS}, round(distance, 9) AS distance
FROM near JOIN a ON a.nome_completo = n1 JOIN b ON b.nome_completo = n2
WHERE distance <= {cfg.max_distance}::DOUBLE"""


# --- generator --------------------------------------------------------------------------------

def _draw(label: str, seed: int, i: int) -> str:
    return f"('0x' || substr(sha256('{seed}:' || id || ':{label}'), {1 + 8 * i}, 8))::BIGINT"


def _listed(words: list[str], draw: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + f"][{draw} % {len(words)} + 1]"


def _random_people(source: str, target: str, seed: int) -> str:
    d = lambda i: _draw("person", seed, i)
    nine = f"lpad(CAST({d(4)} % 1000000000 AS VARCHAR), 9, '0')"
    return f"""
{target}_n AS (SELECT id, {_listed(FIRST_NAMES, d(0))} AS first, {_listed(LAST_NAMES, d(1))} AS middle,
    {_listed(LAST_NAMES, d(2))} AS last, DATE '1950-01-01' + CAST({d(3)} % {DAYS} AS INTEGER) AS birth,
    {nine} AS nine, {_listed(STATUSES, d(5))} AS status FROM {source}),
{target} AS (SELECT id, first, middle, last, strftime(birth, '%Y-%m-%d') AS birth,
    nine || {check_digits('nine')} AS doc, status FROM {target}_n)"""


def generated(overlap: float, variation: float, seed: int) -> str:
    draw = lambda i: _draw("noise", seed, i)
    rate, half = int(round(variation * 1e6)), int(round(variation / 2 * 1e6))
    share = int(round(overlap * 1e6))
    out = lambda table, name, birth, source: (
        f"SELECT '{table}' AS side, {name} AS nome_completo, {birth} AS data_nascimento, "
        f"doc AS nr_documento, status FROM {source}")
    plain = "first || ' ' || middle || ' ' || last"
    return f"""WITH ids AS (SELECT c_custkey AS id FROM customer),
shared AS (SELECT id FROM ids WHERE {_draw('overlap', seed, 0)} % 1000000 < {share}),
own AS (SELECT id FROM ids WHERE {_draw('overlap', seed, 0)} % 1000000 >= {share}),
{_random_people('own', 'pa', seed + 1).strip()},
{_random_people('own', 'pb', seed + 2).strip()},
{_random_people('shared', 'ps', seed).strip()},
noise AS (SELECT *, {", ".join(f"{draw(i)} AS d{i}" for i in range(8))},
    CAST(substr(birth, 6, 2) AS INTEGER) AS mo, CAST(substr(birth, 9, 2) AS INTEGER) AS da FROM ps),
noise2 AS (SELECT *, d0 % 1000000 < {rate} AS noisy, 2 + d2 % greatest(length(first) - 2, 1) AS pos,
    substr('abcdefghijklmnopqrstuvwxyz', CAST(1 + d3 % 26 AS INTEGER), 1) AS letter,
    CASE WHEN d6 % 2 = 0 THEN 1 ELSE -1 END AS step FROM noise),
noise3 AS (SELECT *,
    CASE WHEN noisy AND d1 % 3 = 0 AND length(first) > 3
           THEN left(first, CAST(pos - 1 AS INTEGER)) || letter || substr(first, CAST(pos + 1 AS INTEGER)) || ' ' || middle || ' ' || last
         WHEN noisy AND d1 % 3 = 1 THEN first || ' ' || left(middle, 1) || '. ' || last
         WHEN noisy AND d1 % 3 = 2 THEN first || ' ' || last || ' ' || middle
         ELSE {plain} END AS vname,
    CASE WHEN d4 % 1000000 >= {half} THEN birth
         WHEN d5 % 2 = 0 THEN left(birth, 8) || lpad(CAST(greatest(1, least(28, da + step)) AS VARCHAR), 2, '0')
         ELSE left(birth, 5) || lpad(CAST(greatest(1, least(12, mo + step)) AS VARCHAR), 2, '0') || substr(birth, 8) END AS vbirth
    FROM noise2)
{out('A', plain, 'birth', 'pa')} UNION ALL {out('A', plain, 'birth', 'ps')}
UNION ALL {out('B', plain, 'birth', 'pb')} UNION ALL {out('B', 'vname', 'vbirth', 'noise3')}"""


def linked(model, cuts) -> str:
    """Match weight, probability and decision over `scored`, by given odds."""
    level = {
        "name": "CASE WHEN name_jaro_score >= 0.92::DOUBLE THEN 2 WHEN name_jaro_score >= 0.8::DOUBLE THEN 1 ELSE 0 END",
        "soundex": "CAST(name_soundex_score AS INTEGER)",
        "date": "CASE WHEN date_score >= 1 THEN 3 WHEN date_score >= 0.8::DOUBLE THEN 2 WHEN date_score >= 0.5::DOUBLE THEN 1 ELSE 0 END",
        "document": "CAST(doc_match AS INTEGER)",
    }
    part = lambda f: f"list_extract([{', '.join(f'log2({x}::DOUBLE / {y}::DOUBLE)' for x, y in zip(model.m[f], model.u[f]))}], 1 + {level[f]})"
    return f""",
names AS (SELECT lower(nome_completo) AS name, count(*) AS records FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE length(nome_completo) > 0 GROUP BY 1),
shares AS (SELECT name, records / (SELECT sum(records) FROM names)::DOUBLE AS share FROM names),
w AS (SELECT nr_documento_1, nr_documento_2, round({' + '.join(part(f) for f in level)}
    + CASE WHEN lower(nome_completo_1) = lower(nome_completo_2) THEN log2({model.u['name'][2]}::DOUBLE / share) ELSE 0 END, 9) AS match_weight
    FROM scored LEFT JOIN shares ON lower(nome_completo_1) = shares.name)
SELECT *, round(1 / (1 + {(1 - model.share) / model.share}::DOUBLE * pow(2::DOUBLE, -match_weight)), 9) AS probability,
    CASE WHEN match_weight >= {cuts.link}::DOUBLE THEN 'link' WHEN match_weight <= {cuts.non_link}::DOUBLE THEN 'non_link' ELSE 'review' END AS decision FROM w"""
