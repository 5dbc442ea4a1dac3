"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (ann, cuckoo_dedup, embedding_dedup, html_wrappers, jaccard_join, language_id, merkle, mixing,
                          packing, substring_dedup, token_alignment, toxicity, warc)
from kerbside.llm.common import cut_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Domains of the mixture tree, by the number of a source: fixed values of the query.
DOMAINS = (("web", 8), ("books", 14), ("code", 20))
#: Weights of the mixture's nodes; nodes that are not named weigh ``mixing.DEFAULT_WEIGHT``.
WEIGHTS = {"web": 50, "books": 30, "code": 15, "other": 5, "web/en": 40, "web/de": 20, "web/fr": 20, "web/es": 20,
           "books/en": 60, "code/en": 80, "web/en/src0": 15}


def domain_of() -> Column:
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "^src([0-9]{1,6})$", 1).try_cast("int")
    out = F.lit("other")
    for name, below in reversed(DOMAINS):
        out = F.when(number < below, name).otherwise(out)
    return out


def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.select_tokens(table(spark, sf_dir, "documents"), domain_of(), F.col("total"), WEIGHTS)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit_documents(docs)
    marked = docs.select("doc_id", language_id.held_out().alias("held_out"), "text")
    return language_id.predict(marked, model).select("doc_id", "held_out", "language.lang_pred", "language.score")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.main_text(table(spark, sf_dir, "pages"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup(table(spark, sf_dir, "embeddings"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_repeats(table(spark, sf_dir, "documents"), substring_dedup.PASSAGE_WORDS)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


#: Rows of op11 whose texts are tampered with: one in so many by the checksum of their ids.
TAMPERED_ONE_IN = 5


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"), cut_key() % TAMPERED_ONE_IN == 0)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cuckoo_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {f.__name__: f for f in (
    op1_mixture, op2_packing, op3_language, op4_neighbours, op5_main_text, op6_embedding_dedup, op7_substring_dedup,
    op8_jaccard_join, op9_toxicity, op10_warc, op11_merkle, op12_token_alignment, op13_exact_dedup)}


def _level_sql(k: int) -> str:
    """Budgets of a level of the mixture's tree from those of the level above."""
    family, name = list(mixing.LEVELS[:k]), mixing.LEVELS[k]
    keys, siblings = ", ".join([*family, name]), f"PARTITION BY {', '.join(family)}" if family else ""
    path = " || '/' || ".join([*family, name])
    weights = " ".join(f"WHEN '{p}' THEN {w}" for p, w in sorted(WEIGHTS.items()))
    above = f"JOIN b{k - 1} USING ({', '.join(family)})" if k else "CROSS JOIN b_all"
    order = f"{siblings} ORDER BY cap // greatest(w, 1), (cap % greatest(w, 1))::DOUBLE / greatest(w, 1), {name}"
    return f"""
 n{k} AS (SELECT {keys}, sum(tokens * {mixing.MAX_EPOCHS})::BIGINT AS cap0, CASE {path} {weights} ELSE {mixing.DEFAULT_WEIGHT} END AS w0
  FROM leaves GROUP BY {keys}),
 w{k} AS (SELECT n{k}.*, given AS budget, CASE WHEN sum(w0) OVER ({siblings}) = 0 THEN 1 ELSE w0 END AS w FROM n{k} {above}),
 c{k} AS (SELECT *, CASE WHEN w = 0 THEN 0 ELSE cap0 END AS cap FROM w{k}),
 m{k} AS (SELECT *, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS met,
   sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_w FROM c{k}),
 f{k} AS (SELECT *, cap::HUGEINT * left_w <= w::HUGEINT * greatest(budget - met, 0) AS filled FROM m{k}),
 o{k} AS (SELECT *, sum(CASE WHEN filled THEN 0 ELSE w END) OVER ({order} ROWS UNBOUNDED PRECEDING) AS upto,
   sum(CASE WHEN filled THEN 0 ELSE w END) OVER ({siblings}) AS whole,
   greatest(budget - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({siblings}), 0)::HUGEINT AS share FROM f{k}),
 b{k} AS (SELECT {keys}, CASE WHEN filled THEN cap ELSE share * upto // whole - share * (upto - w) // whole END::BIGINT AS given FROM o{k})"""


_DOMAIN_SQL = "CASE " + " ".join(f"WHEN number < {below} THEN '{name}'" for name, below in DOMAINS) + " ELSE 'other' END"

#: Each leaf's documents in the seeded order, as one running sum; the buckets of the Spark form are not needed here.
_MIXTURE_SQL = f"""WITH d0 AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
   TRY_CAST(regexp_extract(coalesce(source, ''), '^src([0-9]{{1,6}})$', 1) AS INT) AS number,
   len(regexp_extract_all(coalesce(text, ''), '{mixing.TOKEN}')) AS doc_tokens FROM documents),
 d AS (SELECT doc_id, {_DOMAIN_SQL} AS domain, lang, source, doc_tokens FROM d0 WHERE doc_tokens > 0),
 leaves AS (SELECT domain, lang, source, sum(doc_tokens)::BIGINT AS tokens FROM d GROUP BY ALL),
 b_all AS (SELECT least(sum(tokens), sum(tokens * {mixing.MAX_EPOCHS}))::BIGINT AS given FROM leaves),
 {",".join(_level_sql(k) for k in range(len(mixing.LEVELS)))},
 plan AS (SELECT domain, lang, source, given // tokens AS epochs, given % tokens AS rest FROM leaves JOIN b2 USING (domain, lang, source)
  WHERE given > 0),
 k AS (SELECT d.*, epochs, rest FROM d JOIN plan USING (domain, lang, source)),
 part AS (SELECT *, coalesce(sum(doc_tokens) OVER (PARTITION BY domain, lang, source
   ORDER BY md5(concat_ws(':', '{mixing.SEED}', epochs::VARCHAR, coalesce(doc_id::VARCHAR, ''))), doc_id, doc_tokens
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM k)
 SELECT doc_id, domain, lang, source, doc_tokens::BIGINT AS doc_tokens, epoch::BIGINT AS epoch, doc_tokens::BIGINT AS take_tokens
  FROM k, unnest(range(epochs)) AS u(epoch)
 UNION ALL SELECT doc_id, domain, lang, source, doc_tokens, epochs::BIGINT, least(doc_tokens, rest - start)::BIGINT FROM part WHERE start < rest"""

_WARC_SQL = f"""WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
 f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
 SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= {warc.MIN_REVISIT} AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {warc.MIN_REVISIT} AND first < page_id THEN first END AS refers_to FROM f"""

#: Levels that the SQL of op11 can climb: 16^6 leaves a source, 16^4 sources.
_LEAF_LEVELS, _TOP_LEVELS = 6, 4


def _field_sql(x: str) -> str:
    return f"coalesce(strlen({x}) || ':' || {x}, '-')"


def _leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return f"sha256({' || '.join(_field_sql(x) for x in fields)})"


def _crc32_sql(x: str) -> str:
    """The unsigned checksum of a text of ASCII characters: eight steps (-1) after each character's code."""
    codes = f"flatten(list_transform(string_split({x}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN k >= 0 THEN xor(c, k) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, k: {step}), 4294967295)"


def _levels_sql(name: str, most: int) -> str:
    """The levels over ``name``0 (tree, idx, n, digest)."""
    a = merkle.ARITY
    return ", ".join(f"""{name}{k} AS (SELECT tree, idx // {a} AS idx, (n + {a - 1}) // {a} AS n, sha256(string_agg(digest, '' ORDER BY idx)) AS digest,
  list(digest ORDER BY idx) AS run FROM {name}{k - 1} WHERE n > 1 GROUP BY tree, idx // {a}, (n + {a - 1}) // {a})""" for k in range(1, most + 1))


def _climb_sql(start: str, name: str, most: int, out: str) -> str:
    """``out``: the rows of ``start`` (tree, idx, now, others) with the siblings (_s) and the fold (now) of all levels."""
    a, parts, last = merkle.ARITY, [], start
    for k in range(1, most + 1):
        slot = f"(p.idx // {a ** (k - 1)}) % {a}"
        left, right = f"array_to_string(run[1:{slot}], '')", f"array_to_string(run[{slot} + 2:], '')"
        parts.append(f"""{out}{k} AS (SELECT p.* REPLACE (CASE WHEN run IS NULL THEN now ELSE sha256({left} || now || {right}) END AS now,
   CASE WHEN run IS NULL THEN _s ELSE _s || {left} || {right} END AS _s)
  FROM {last} p LEFT JOIN {name}{k} l ON l.tree = p.tree AND l.idx = p.idx // {a ** k})""")
        last = f"{out}{k}"
    return ", ".join(parts)


_MERKLE_SQL = f"""WITH d AS (SELECT doc_id, coalesce('+' || source, '') AS tree, {_leaf_sql('text')} AS leaf,
   CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % {TAMPERED_ONE_IN} = 0 THEN {_leaf_sql(f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')")}
    ELSE {_leaf_sql('text')} END AS now FROM documents),
 p0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n,
   '' AS _s FROM d),
 l0 AS (SELECT tree, idx, n, leaf AS digest FROM p0),
 {_levels_sql('l', _LEAF_LEVELS)},
 roots AS ({' UNION ALL '.join(f'SELECT tree, digest FROM l{k} WHERE n = 1' for k in range(_LEAF_LEVELS + 1))}),
 r AS (SELECT tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM roots),
 t0 AS (SELECT '' AS tree, idx, n, digest FROM r),
 {_levels_sql('t', _TOP_LEVELS)},
 root AS ({' UNION ALL '.join(f'SELECT digest FROM t{k} WHERE n = 1' for k in range(_TOP_LEVELS + 1))}),
 {_climb_sql('p0', 'l', _LEAF_LEVELS, 'p')},
 q0 AS (SELECT p.doc_id, p.leaf, p.now, p._s, r.digest AS subroot, '' AS tree, r.idx FROM p{_LEAF_LEVELS} p JOIN r ON r.name = p.tree),
 {_climb_sql('q0', 't', _TOP_LEVELS, 'q')}
 SELECT doc_id, leaf, subroot, digest AS root, sha256(_s) AS proof_sha256, now AS folded_root, now = digest AS verified
 FROM q{_TOP_LEVELS}, root"""

_DEDUP_SQL = """WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t, length(coalesce(text, '')) AS n FROM documents),
 k AS (SELECT *, sha256(t) AS text_sha256, count(*) OVER (PARTITION BY t) AS group_size, row_number() OVER o AS place,
   first_value(doc_id) OVER o AS keep_id FROM d WINDOW o AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST))
 SELECT doc_id, keep_id, group_size::BIGINT AS group_size, place = 1 AS kept, text_sha256 FROM k"""

#: The other operators use trained models, min-hash values, graphs or token ids, which SQL cannot express (or, like the
#: exact Jaccard join of all texts, not at an acceptable cost); their tests compare them with brute force.
ORACLE = {"op1_mixture": _MIXTURE_SQL, "op10_warc": _WARC_SQL, "op11_merkle": _MERKLE_SQL, "op13_exact_dedup": _DEDUP_SQL}
