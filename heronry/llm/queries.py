"""The operators bound to the test tables: one query each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_automaton, docsketch, langid, mixing, packing, pii, quality, secrets, simhash, suffixdedup, topk, variants, whitening
from .scratch import written
from .succession import successors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def spans_of(column: str, kind: str) -> Column:
    return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(~langid.held_out(F.col("doc_id"))))
    key = F.col("doc_id")
    return langid.identify(docs, model, keep=[key, langid.held_out(key).alias("held_out")])


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"), keep=[F.col("doc_id")])
    counts = [spans_of("base", k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, digest(pii.span_text(F.col("base"))).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prints = written(simhash.fingerprints(docs, keep=[F.col("doc_id")], words=3).select("doc_id", F.col("fp")[0].alias("fp")), "prints")
    found = simhash.classes(prints, simhash.exact_links(prints), key="doc_id")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixdedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", topk.scaled(F.col("embedding")).alias("v"))
    vectors = topk.vectors_of(rows, key="vec_id", vector="v")
    file, grids = topk.approximations(vectors, k=20)
    return topk.search(vectors.where("id % 20 = 0"), file, grids, k=20).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), keep=[F.col("doc_id")])


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null id sorts last, as the least long (which stands for null here); of rows with one id, texts follow each other by their hash; equal rows have one successor and each keep their row."""
    least = F.lit(-(1 << 63))
    docs = table(spark, sf_dir, "documents").select(F.coalesce("doc_id", least).alias("at"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("tie", F.xxhash64("text"))
    keys = docs.select("at", "tie", F.char_length("text").cast("long").alias("n")).distinct()
    order = successors(keys, "at", "tie").withColumn("cut", F.floor(F.col("n") / 3).cast("int"))
    # both joins below read one and the same exchange: texts are sketched and shuffled once
    sketched = docs.withColumn("own", docsketch.sketch(F.col("text"))).repartition("at", "tie")
    follower = sketched.select(F.col("at").alias("next_at"), F.col("tie").alias("next_tie"), F.col("text").alias("next_text"), F.col("own").alias("next_own"))
    ahead = follower.join(order.hint("shuffle_hash"), ["next_at", "next_tie"]).select("at", "tie", "n", "cut", F.expr("left(next_text, cut)").alias("head"), "next_own")
    ahead = ahead.groupBy("at", "tie").agg(*[F.any_value(c).alias(c) for c in ("n", "cut", "head", "next_own")])
    both = sketched.join(ahead.hint("shuffle_hash"), ["at", "tie"])
    both = both.withColumn("edited", F.concat(F.expr("left(text, cast(n as int) - cut)"), "head"))
    both = both.withColumn("edited_own", docsketch.sketch(F.col("edited")))
    near = lambda c: docsketch.resemblance(F.col("own"), F.col(c))
    return both.select(F.nullif("at", least).alias("doc_id"), F.col("n").alias("n_chars"), digest(F.col("edited")).alias("edited_sha256"), docsketch.text_of(F.col("own")).alias("fingerprint"), docsketch.text_of(F.col("edited_own")).alias("edited_fingerprint"), near("edited_own").alias("near_edited"), near("next_own").alias("near_next"), docsketch.distinct_count(F.col("own")).alias("n_shingles"), docsketch.containment(F.col("own"), F.col("edited_own")).alias("contained_edited"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"), keep=[F.col("doc_id")])
    counts = [spans_of("base", k).alias(f"n_{k}") for k in secrets.KINDS[:3]]
    return found.select("doc_id", *counts, digest(secrets.span_text("base")).alias("base_sha256"), secrets.span_text("spans").alias("spans"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=[F.col("doc_id")])
    return scored.select("doc_id", "score", (F.col("score") >= quality.KEEP).alias("keep"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    encoded = bpe_automaton.encode(table(spark, sf_dir, "documents"), path, keep=[F.col("doc_id")])
    decoded = bpe_automaton.decode(encoded, path)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(ids).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), key="vec_id", vector="embedding").withColumnRenamed("id", "vec_id")


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.grouped(variants.words(table(spark, sf_dir, "documents")), least_length=variants.LENGTH).select("word", "form", "root", "n", "n_near", "form_n")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.sized(table(spark, sf_dir, "documents"))
    sources = mixing.plan(rows)
    rows = mixing.placed(rows, sources)
    own = spark.createDataFrame([(s.number, s.size, s.target) for s in sources], "src int, source_size long, target double")
    found = mixing.taken(rows, mixing.mix(rows, sources)).join(F.broadcast(own), "src")  # the list of sources
    return found.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_pii, op3_simhash, op4_suffix_dedup, op5_topk, op6_packing, op7_fingerprint, op8_secrets, op9_quality, op10_bpe, op11_whitening, op12_variants, op13_mixing)
}
ORACLE_SQL: dict[str, str] = {
    "op4_suffix_dedup": """
        with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
        w as (select doc_id, k, substr(h, 2 * k + 1, 100) as s from (select doc_id, h, unnest(range(0, length(h) // 2 - 49)) as k from d)),
        f as (select s, min(doc_id) as first from w group by s),
        gone as (select doc_id, k, lag(k) over (partition by doc_id order by k) as before from w join f using (s) where first < doc_id),
        runs as (select *, sum(case when before is null or k > before + 50 then 1 else 0 end) over (partition by doc_id order by k) as run from gone),
        spans as (select doc_id, run, min(k) as a, max(k) + 50 as b from runs group by doc_id, run),
        cuts as (select *, coalesce(lag(b) over (partition by doc_id order by a), 0) as last from spans),
        kept as (select doc_id, sum(b - a) as n, count(*) as c, string_agg(substr(h, 2 * last + 1, 2 * (a - last)), '' order by a) || substr(any_value(h), 2 * max(b) + 1) as left_
                 from cuts join d using (doc_id) group by doc_id)
        select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n, 0)::bigint as n_removed, coalesce(c, 0)::bigint as n_spans, sha256(unhex(coalesce(left_, h))) as kept_sha256
        from d left join kept using (doc_id)
    """,
    "op5_topk": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(x::double * 64)::bigint) as v from embeddings
                   where vec_id is not null and embedding is not null
                     and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
        scored as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
                   from v q, v c where q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
        ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
        select query_id, rank::int as rank, vec_id, score from ranked where rank <= 20
    """,
}
