"""The registered queries of this package and their SQL answers."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, langid, lexical, licenses, lm, mixing, quality, simhash, suffixes, tokens, topk, urls, whiten
from millrace.llm.text import id_remainder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            reach(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


BATCH_BYTES = "8m"


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the session was started.

    A row is a whole document here, so batches for Python workers are cut by bytes, unless the
    session has a limit of its own.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(limit):
        spark.conf.set(limit, BATCH_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "documents"))


@query("op2_licenses")
def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query("op3_lm")
def op3_lm(spark: SparkSession, folder: str) -> DataFrame:
    held = id_remainder(F.col("doc_id"), 7) == 2
    scored = lm.score(table(spark, folder, "documents"), ~held)
    return scored.withColumn("held_out", ~F.col("train")).drop("train")


URL_RULES = ["allow org/", "allow com/fr/", "block com/de/", "block example.org/es/", "block example.org/en/1"]


@query("op4_urls")
def op4_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), [urls.PrefixRule.parse(r) for r in URL_RULES])


@query(
    "op5_quality",
    """
    with docs as (
      select row_number() over () as rid, doc_id, source, coalesce(text, '') as text from documents
    ), tokens as (
      select rid, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from docs
    ), windows as (
      select rid, i, list_slice(w, i, i + 7) as win
      from (select rid, w, unnest(range(1, len(w) - 6)) as i from tokens where len(w) >= 8)
    ), twins as (
      select rid, i from (select rid, i, count(*) over (partition by rid, win) as n from windows) where n > 1
    ), repeats as (
      select rid, count(distinct j) as n from (select rid, unnest(range(i, i + 8)) as j from twins) group by rid
    ), lines as (
      select rid, source, line, len(list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) as words
      from (select rid, source, unnest(string_split(text, chr(10))) as line from docs)
    ), keyed as (
      select rid, source, words, line,
        ('0x' || substr(md5(regexp_replace(trim(regexp_replace(lower(line), '[\\x20\\x09-\\x0D]+', ' ', 'g')),
          '[0-9]+', '0', 'g')), 1, 15))::bigint as key
      from lines where words > 0
    ), dups as (
      select rid, count(*) - count(distinct line) as n from keyed group by rid
    ), often as (
      select k.source, k.key from keyed k join docs d using (rid)
      group by k.source, k.key having count(distinct d.text) > 20
    ), cut as (
      select k.rid, sum(k.words) as n from keyed k join often o
        on k.source is not distinct from o.source and k.key = o.key group by k.rid
    ), stats as (
      select d.doc_id, len(t.w)::bigint as n_words, length(translate(d.text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::bigint as word_chars,
        (length(d.text) - length(translate(d.text, '#*$%&|<>', '')))::bigint as n_symbols,
        coalesce(u.n, 0)::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words, coalesce(c.n, 0)::bigint as removed_words
      from docs d join tokens t using (rid) left join dups u using (rid) left join repeats r using (rid) left join cut c using (rid)
    ), failed as (
      select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from stats
    )
    select *, not base_failed and n_words - removed_words >= 0.25 * n_words as kept from failed
    """,
)
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


@query(
    "op6_topk",
    """
    with held as (
      select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
      from embeddings
      where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
      select q.rid, q.vec_id as query_id, c.vec_id,
        list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::bigint as score
      from held q join held c on q.vec_id % 50 = 0 and c.rid <> q.rid
    ), ranked as (
      select *, row_number() over (partition by rid order by score desc, vec_id)::int as rank from scored
    )
    select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
)
def op6_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query(
    "op7_mixing",
    """
    with sized as (
      select doc_id, source, md5(coalesce(text, '')) as digest,
        row_number() over (partition by doc_id, coalesce(text, ''), source) as number,
        len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))::bigint as size
      from documents
    ), sums as (
      select source, sum(size)::bigint as source_size,
        (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
      from sized group by source
    ), ranked as (
      select *, 3 * source_size as cap, sum(source_size) over () as total, sum(weight) over () as weights,
        coalesce(sum(3 * source_size) over w, 0) as full_size, coalesce(sum(weight) over w, 0) as spent
      from sums
      window w as (order by 3 * source_size / weight, source nulls first rows between unbounded preceding and 1 preceding)
    ), tried as (
      select *, (total - full_size)::double / (weights - spent)::double as u from ranked
    ), units as (
      select *, first_value(case when u * weight <= cap then u end ignore nulls)
        over (order by cap / weight, source nulls first rows between unbounded preceding and current row) as unit
      from tried
    ), targets as (
      select source, source_size, case when unit is null then cap::double else unit * weight end as target from units
    ), rates as (
      select s.doc_id, s.size, s.digest, s.number, t.source_size, t.target,
        case when t.source_size > 0 then least(t.target / t.source_size, 3.0::double) else 0.0::double end as rate
      from sized s join targets t on s.source is not distinct from t.source
    )
    select doc_id, size, source_size, target, size * (floor(rate)::bigint + case when
      ('0x' || substr(md5('0:' || coalesce(doc_id::varchar, '') || ':' || digest || ':' || number), 1, 8))::bigint / 4294967296.0::double < rate - floor(rate)
      then 1 else 0 end) as taken
    from rates
    """,
)
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return planned.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


@query("op8_language")
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = id_remainder(F.col("doc_id"), 3) == 1
    model = langid.learn(docs.where(~held))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held.alias("held_out"), "language.lang_pred", "language.score")


@query("op9_simhash")
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


@query("op10_bpe")
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.code(table(spark, folder, "documents"), bpe.read_description())


@query(
    "op11_lexical",
    r"""
    with words as (
      select rid, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
      from (select row_number() over () as rid, doc_id as id, text from documents)
    ), sizes as (
      select rid, any_value(id) as doc_id, count(*)::bigint as n from words group by rid
    ), corpus as (
      select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from sizes
    ), counted as (
      select rid, term, count(*)::bigint as tf from words group by rid, term
    ), weights as (
      select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
      from counted, corpus group by term, n_docs
    ), asked as (
      select distinct iid, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
      from (select row_number() over () as iid, item_id, text from benchmark)
    ), scored as (
      select a.iid, a.item_id, c.rid, s.doc_id,
        sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (10 + (90 * s.n * k.n_docs) // k.n_terms))))::bigint as score
      from asked a join counted c using (term) join weights w using (term) join sizes s on s.rid = c.rid, corpus k
      group by a.iid, a.item_id, c.rid, s.doc_id
    ), ranked as (
      select *, row_number() over (partition by iid order by score desc, doc_id nulls last)::int as rank from scored where score > 0
    )
    select item_id, rank, doc_id, score from ranked where rank <= 10
    """,
)
def op11_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten.whiten(table(spark, folder, "embeddings"))


@query(
    "op13_suffixes",
    """
    with docs as (
      select row_number() over () as rid, doc_id, hex(encode(coalesce(text, ''))) as bytes from documents
    ), starts as (
      select rid, p, md5(substr(bytes, 2 * p + 1, 800)) as string
      from (select rid, bytes, unnest(range(0, len(bytes) // 2 - 399)) as p from docs where len(bytes) >= 800)
    ), twice as (
      select rid, p from (select rid, p, count(*) over (partition by string) as n from starts) where n > 1
    ), marked as (
      select rid, p, case when p <= lag(p) over (partition by rid order by p) + 400 then 0 else 1 end as new from twice
    ), runs as (
      select rid, run, min(p) as a, max(p) + 400 as b
      from (select rid, p, sum(new) over (partition by rid order by p) as run from marked) group by rid, run
    ), edges as (
      select rid, a, b, coalesce(lag(b) over (partition by rid order by a), 0) as c from runs
    ), kept as (
      select d.rid, sum(b - a) as gone, count(*) as n,
        string_agg(substr(bytes, 2 * c + 1, 2 * (a - c)), '' order by a) || any_value(substr(bytes, 2 * last + 1)) as bytes
      from docs d join edges using (rid) join (select rid, max(b) as last from runs group by rid) using (rid) group by d.rid
    )
    select doc_id, (len(d.bytes) // 2)::bigint as n_bytes, coalesce(k.gone, 0)::bigint as n_removed, coalesce(k.n, 0)::bigint as n_spans,
      sha256(unhex(coalesce(k.bytes, d.bytes))) as kept_sha256
    from docs d left join kept k using (rid)
    """,
)
def op13_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, folder, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda total, run: total + run["end"] - run["start"])
    return found.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
