"""The library's operators over the test tables: queries, and the same in SQL for DuckDB.

Conventions: a document's source is ``documents.source``, its id ``doc_id``;
its tier follows from the id; vectors belong to documents of the same id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import chunk, embed, evaluate, nearby, prompt, scan, search, store
from .operators.nearby import CellIndex
from .operators.postings import InvertedIndex
from .scratch import place, written
from .sources import corpus, manifest
from .streaming.index import StreamIndex

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; texts that lie in fewer pieces than there are cores are dealt out first, which larger tables never need."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in ("documents", "pages") and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def tier_of(i: Column) -> Column:
    return F.when(i % 3 == 0, "pinned-source").when(i % 3 == 1, "docs-wiki").otherwise("navigational")


_TIER = "case {0} % 3 when 0 then 'pinned-source' when 1 then 'docs-wiki' else 'navigational' end"
_W = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _trim(x: str) -> str:
    return rf"regexp_replace({x}, '^{_W}+|{_W}+$', '', 'g')"


def _collapse(x: str) -> str:
    return _trim(f"regexp_replace({x}, '{_W}+', ' ', 'g')")


def _strip(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]*>?', '', 'g')"
    for a, b in T.ENTITIES:
        x = "replace({}, '{}', '{}')".format(x, a.replace("'", "''"), b.replace("'", "''"))
    return x


_WORDS = r"list_transform(regexp_extract_all(regexp_replace({0}, '([a-z])([A-Z])', '\1 \2', 'g'), '[\p{{L}}\p{{N}}_]+'), lambda w: lower(w))"


# Sources


@query("""
    select source as name, source || case when right(source, 1)::int % 2 = 0 then '.txt' else '.html' end as file
    from (select distinct source from documents where source is not null)
""")
def manifest_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "documents").select(F.col("source").alias("name")).where("name is not null").distinct()
    kind = F.when(F.right("name", F.lit(1)).cast("int") % 2 == 0, "text").otherwise("html")
    return names.select("name", manifest.file_name(F.col("name"), kind).alias("file"))


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of the documents' sources in the order of their names; some leave out a tier or a format."""
    name = F.col("name")
    nth = F.length("name") % 3
    fields = F.struct(
        name, F.lit("MIT").alias("license"), F.concat(F.lit("https://x/"), name).alias("url"), F.lit(None).cast("string").alias("hash"),
        F.when(nth == 0, "docs-wiki").when(nth == 1, "navigational").alias("tier"), F.when(F.right("name", F.lit(1)).cast("int") % 2 == 0, "text").alias("format"),
    )
    names = table(spark, sf_dir, "documents").select(F.col("source").alias("name")).where("name is not null").distinct()
    # a manifest is one hand-written list, so it is one row
    return manifest.of(names.agg(F.lit(1).alias("version"), F.array_sort(F.collect_list(fields)).alias("sources")))


_SOURCES = """
    sources as (select (row_number() over (order by name) - 1)::int as ord, 1 as version, name, 'MIT' as license, 'https://x/' || name as url, null::varchar as hash,
        case length(name) % 3 when 0 then 'docs-wiki' when 1 then 'navigational' else 'pinned-source' end as tier, case when right(name, 1)::int % 2 = 0 then 'text' else 'html' end as format
        from (select distinct source as name from documents where source is not null))
"""


@query(f"with {_SOURCES} select * from sources")
def manifest_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sources(spark, sf_dir)


def _pinned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages = table(spark, sf_dir, "pages")
    name = F.concat(F.lit("page"), F.col("page_id").cast("string"))
    pin = F.when(F.col("page_id") % 5 == 0, F.lit(None)).when(F.col("page_id") % 2 == 0, F.sha2("html", 256)).otherwise("0")
    sources = pages.select(F.col("page_id").alias("ord"), name.alias("name"), pin.alias("hash"), F.lit("html").alias("format"))
    return sources, pages.select(F.concat(name, F.lit(".html")).alias("file"), F.col("html").cast("binary").alias("content"))


@query("""
    select page_id as ord, 'page' || page_id as name, case when page_id % 5 = 0 then null when page_id % 2 = 0 then sha256(html) else '0' end as expected,
           sha256(html) as actual, case when page_id % 5 <> 0 and page_id % 2 = 0 then 'skipped' else 'fetched' end as action from pages
""")
def ingest_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.verify(*_pinned(spark, sf_dir))


@query("select count(*) as fetched from pages where page_id % 5 = 0 or page_id % 2 = 1")
def ingest_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.verify(*_pinned(spark, sf_dir)).where("action = 'fetched'").agg(F.count("*").alias("fetched"))


# Text


@query(rf"""
    select page_id, sha256({_strip("html")}) as stripped, length({_collapse(_strip("html"))}) as n_collapsed,
           ceil(length(html) / 4.0)::int as tokens, right(html, 200) as tail,
           case when length({_trim("html")}) <= 140 then {_trim("html")} else left({_trim("html")}, 140) || '…' end as snippet,
           regexp_replace(url, '\.[^.]*$', '') as stem
    from pages
""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", T.sha256(T.strip_tags(html)).alias("stripped"), F.length(T.collapse(T.strip_tags(html))).cast("long").alias("n_collapsed"),
        T.tokens_of(html).alias("tokens"), T.overlap(html).alias("tail"), T.cut(html, 140).alias("snippet"), T.stem(F.col("url")).alias("stem"),
    )


@query(f"""
    select term, count(*) as cf, count(distinct doc_id) as df
    from (select doc_id, unnest({_WORDS.format("text")}) as term from documents) group by term
""")
def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = table(spark, sf_dir, "documents").select("doc_id", F.explode_outer(T.words(F.col("text"))).alias("term")).where("term is not null")
    each = terms.groupBy("term", "doc_id").agg(F.count("*").alias("n"))
    return each.groupBy("term").agg(F.sum("n").alias("cf"), F.count("*").alias("df"))


# Chunks

_HTML = ("{0}", r"(?s)<h[1-6][^>]*(?:>|\z)(.*?)(?:</h[^>]*(?:>|\z)|\z)")
_TEXT = (r"""regexp_replace(replace({0}, chr(13) || chr(10), chr(10)) || case when {0} = '' or right({0}, 1) = chr(10) then '' else chr(10) end,
            '([^\n]*)\n', chr(10) || '\1' || chr(10), 'g')""", r"\n===== FILE: ([^\n]*) =====\n")


def _sections_sql(cut: tuple[str, str], heading: str, body: str) -> str:
    """What stands between the matches of a pattern, each with the group of the match before it."""
    text, pattern = cut
    return f"""list_filter(list_transform(list_zip(string_split_regex({text}, '{pattern}'), list_concat([''], regexp_extract_all({text}, '{pattern}', 1))),
        lambda z: {{'heading': {heading.format("z[2]")}, 'text': {body.format("z[1]")}}}), lambda s: {_trim("s.text")} <> '' or s.heading <> '')"""


_HTML_SECTIONS = _sections_sql(_HTML, _trim(_strip("{0}")).replace("{0}", "§").replace("{", "{{").replace("}", "}}").replace("§", "{0}"), _collapse(_strip("{0}")).replace("{0}", "§").replace("{", "{{").replace("}", "}}").replace("§", "{0}"))
_TEXT_SECTIONS = _sections_sql(_TEXT, _trim("{0}").replace("{0}", "§").replace("{", "{{").replace("}", "}}").replace("§", "{0}"), r"regexp_replace({0}, '\n([^\n]*)\n', '\1' || chr(10), 'g')")


def _chunks_sql(sections: str, docs: str) -> str:
    """docs gives ord, name, tier, content."""
    sections = sections.replace("{0}", "content")
    tokens = lambda x: f"ceil(length({x}) / 4.0)"
    return f"""
        with docs as ({docs}), secs as (select ord, name, tier, list_filter({sections}, lambda s: {_trim("s.text")} <> '') as secs from docs),
        folded as (select ord, name, tier, list_reduce(secs, lambda a, s:
            case when {tokens("s.text")} > 500 then
                {{'out': list_concat(list_concat(a.out, case when a.p <> '' then [{{'heading': a.ph, 'text': a.p}}] else [] end),
                    list_transform(range(0, length(s.text), 2000), lambda k: {{'heading': s.heading, 'text': substr(s.text, (k + 1)::bigint, 2000)}})), 'p': '', 'ph': ''}}
            when a.p = '' then {{'out': a.out, 'p': s.text, 'ph': s.heading}}
            when {tokens("a.p")} + {tokens("s.text")} > 500 then
                {{'out': list_concat(a.out, [{{'heading': a.ph, 'text': a.p}}]), 'p': right(a.p, 200) || ' ' || s.text, 'ph': s.heading}}
            else {{'out': a.out, 'p': a.p || ' ' || s.text, 'ph': a.ph}} end,
            {{'out': []::struct(heading varchar, "text" varchar)[], 'p': '', 'ph': ''}}) as f from secs),
        pieces as (select ord, name, tier, list_concat(f.out, case when f.p <> '' then [{{'heading': f.ph, 'text': f.p}}] else [] end) as out from folded),
        flat as (select ord, name, tier, unnest(out) as c, generate_subscripts(out, 1) as pos from pieces),
        made as (select ord, name, tier, pos, c.heading as heading, {_trim("c.text")} as text from flat),
        once as (select *, row_number() over (partition by ord, sha256(text) order by pos) as n from made)
        select ord as source_ord, (row_number() over (partition by ord order by pos) - 1)::int as chunk_ord, sha256(text) as id, name as source, 'MIT' as license, tier, heading,
               ceil(length(text) / 4.0)::int as tokens, text from once where n = 1
    """


def _documents(rows: DataFrame, format_: str) -> DataFrame:
    return rows.select("ord", F.col("ord").cast("string").alias("name"), F.lit("MIT").alias("license"), tier_of(F.col("ord")).alias("tier"), F.lit(format_).alias("format"), "content")


@query(f"""
    with p as (select page_id, {_HTML_SECTIONS.replace("{0}", "html")} as secs from pages),
    flat as (select page_id, unnest(secs) as s, generate_subscripts(secs, 1) as pos from p)
    select page_id, (pos - 1)::int as pos, s.heading as heading, s.text as text from flat
""")
def html_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode_outer(chunk.html_sections(F.col("html"))).alias("pos", "s")).where("s is not null").select("page_id", "pos", "s.heading", "s.text")


@query(_chunks_sql(_HTML_SECTIONS, f"select page_id as ord, page_id::varchar as name, {_TIER.format('page_id')} as tier, html as content from pages"))
def chunk_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.chunks(_documents(table(spark, sf_dir, "pages").select(F.col("page_id").alias("ord"), F.col("html").alias("content")), "html"))


@query(_chunks_sql(_HTML_SECTIONS, f"select page_id // 10 as ord, (page_id // 10)::varchar as name, {_TIER.format('(page_id // 10)')} as tier, string_agg(html, chr(10) order by page_id) as content from pages group by page_id // 10"))
def chunk_merged_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten pages make a document, so that sections of several headings merge."""
    parts = table(spark, sf_dir, "pages").groupBy(F.floor(F.col("page_id") / 10).alias("ord")).agg(F.array_sort(F.collect_list(F.struct("page_id", "html"))).alias("ps"))
    return chunk.chunks(_documents(parts.select("ord", F.array_join(F.transform("ps", lambda p: p["html"]), "\n").alias("content")), "html"))


_MARKED = "'===== FILE: a/' || doc_id || '.txt =====' || chr(10) || text || chr(13) || chr(10) || '===== FILE: b/' || source || ' =====' || chr(10) || left(text, 300) || chr(10) || '===== FILE: =====' || chr(10)"


@query(_chunks_sql(_TEXT_SECTIONS, f"select doc_id as ord, doc_id::varchar as name, {_TIER.format('doc_id')} as tier, {_MARKED} as content from documents"))
def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.concat(
        F.lit("===== FILE: a/"), F.col("doc_id").cast("string"), F.lit(".txt =====\n"), F.col("text"), F.lit("\r\n===== FILE: b/"), F.col("source"),
        F.lit(" =====\n"), F.left("text", F.lit(300)), F.lit("\n===== FILE: =====\n"),
    )
    return chunk.chunks(_documents(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), marked.alias("content")), "text"))


@query(_chunks_sql(_TEXT_SECTIONS, f"select doc_id as ord, source as name, {_TIER.format('doc_id')} as tier, text as content from documents where text is not null"))
def stream_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks of an index that has followed all documents as a stream."""
    kind = table(spark, sf_dir, "documents").schema
    arriving = spark.readStream.schema(kind).parquet(f"{sf_dir}/documents.parque[t]")  # a pattern, as a stream's path may not be a file
    docs = arriving.select(F.col("doc_id").alias("ord"), F.col("source").alias("name"), F.lit("MIT").alias("license"), tier_of(F.col("doc_id")).alias("tier"), F.lit("text").alias("format"), F.col("text").alias("content"), F.lit(0).cast("long").alias("version"))
    index = StreamIndex(spark, place(spark, "stream"))
    index.follow(docs).awaitTermination()
    return index.chunks()


_FILES = "'===== FILE: ' || doc_id || '.txt =====' || chr(10) || coalesce(text, '') || chr(10)"


@query(_chunks_sql(_TEXT_SECTIONS, f"select substr(source, 4)::bigint as ord, source as name, {_TIER.format('substr(source, 4)::bigint')} as tier, string_agg({_FILES}, '' order by doc_id) as content from documents where source is not null group by source"))
def chunk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents of a source make one text, which is chunked without ever being in one row."""
    rows = table(spark, sf_dir, "documents").where("source is not null").withColumn("doc", F.substring("source", 4, 20).cast("long"))
    files = rows.select("doc", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.col("doc_id").alias("path"), "text")
    docs = rows.select(F.col("doc").alias("ord"), F.col("source").alias("name"), F.lit("MIT").alias("license"), tier_of(F.col("doc")).alias("tier")).distinct()
    return scan.chunks(docs, scan.file_sections(files))


def _as_chunks(docs: DataFrame) -> DataFrame:
    """Documents as chunks of their source, with their id as the chunk's."""
    key = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    return docs.select(F.col("doc_id").alias("source_ord"), F.lit(0).alias("chunk_ord"), key.alias("id"), "source", F.lit("MIT").alias("license"), tier_of(F.col("doc_id")).alias("tier"), F.lit("").alias("heading"), T.tokens_of(F.col("text")).alias("tokens"), "text")


@query("select doc_id, sha256(text) as id from documents qualify row_number() over (partition by sha256(text) order by doc_id) = 1")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row of each text: a minimum by order, combined before the shuffle."""
    rows = table(spark, sf_dir, "documents").select(T.sha256(F.col("text")).alias("id"), "doc_id")
    return rows.groupBy("id").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "id")


@query(f"select sha256(text) as id, source, {_TIER.format('doc_id')} as tier, doc_id as source_ord from documents qualify row_number() over (partition by sha256(text) order by doc_id desc) = 1")
def dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(T.sha256(F.col("text")).alias("id"), "source", tier_of(F.col("doc_id")).alias("tier"), F.col("doc_id").alias("source_ord"), F.lit(0).alias("chunk_ord"))
    return store.last_chunks(rows).select("id", "source", "tier", "source_ord")


# Vectors

_STORE = f"""
    emb as (select lpad(vec_id::varchar, 12, '0') as id, vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings),
    chunks as (select lpad(doc_id::varchar, 12, '0') as id, source, {_TIER.format("doc_id")} as tier, text from documents),
    store as (select c.*, v from chunks c join emb e on c.id = e.id)
"""
_COS = "case when list_inner_product(q.v, s.v) is null or list_inner_product(q.v, q.v) = 0 or list_inner_product(s.v, s.v) = 0 then 0 else list_inner_product(q.v, s.v) / (sqrt(list_inner_product(q.v, q.v)) * sqrt(list_inner_product(s.v, s.v))) end"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.lpad(F.col("vec_id").cast("string"), 12, "0").alias("id"), "embedding", "vec_id")


def _store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.load(_as_chunks(table(spark, sf_dir, "documents")), _vectors(spark, sf_dir))


@query("select e.vec_id as id from embeddings e anti join documents d on e.vec_id = d.doc_id")
def store_ghosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vectors = table(spark, sf_dir, "documents"), table(spark, sf_dir, "embeddings")
    return store.ghosts(docs.select(F.col("doc_id").alias("id")), vectors.select(F.col("vec_id").alias("id")))


@query("select distinct d.doc_id as id from documents d anti join embeddings e on e.vec_id = d.doc_id")
def store_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vectors = table(spark, sf_dir, "documents"), table(spark, sf_dir, "embeddings")
    return store.orphans(docs.select(F.col("doc_id").alias("id")), vectors.select(F.col("vec_id").alias("id")))


@query("select vec_id as id, len(v)::int as got from (select vec_id, case when vec_id % 7 = 3 then embedding[1:63] else embedding end as v from embeddings) where len(v) <> 64")
def store_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("vec_id") % 7 == 3, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    return store.misfits(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), v.alias("embedding")), 64)


_PLAN = """
    with c as (select distinct sha256(text) as id from documents), e as (select distinct sha256(text) as id from documents where doc_id % 3 < 2 union select sha256(html) from pages)
    select coalesce(c.id, e.id) as id, case when c.id is null then 'stale' when e.id is null then 'pending' else 'reuse' end as action from c full join e on c.id = e.id
"""


@query(_PLAN)
def embed_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    old = docs.where("doc_id % 3 < 2").select(T.sha256(F.col("text")).alias("id")).union(pages.select(T.sha256(F.col("html"))))
    return embed.plan(docs.select(T.sha256(F.col("text")).alias("id")), old)


def measure(inputs: list[str]) -> list[list[float]]:
    """A fixed embedder: bytes, characters and lines."""
    return [[float(len(x.encode())), float(len(x)), float(x.count("\n") + 1)] for x in inputs]


@query("""
    with d as (select sha256(text) as id, doc_id, text from documents)
    select id, case when min(doc_id % 3) = 0 and max(doc_id % 3) = 0 then 0.0 when min(doc_id % 3) = 0 then 0.0 else any_value(strlen(text))::double end as bytes,
           case when min(doc_id % 3) = 0 then 0.0 else any_value(length(text))::double end as chars,
           case when min(doc_id % 3) = 0 then 0.0 else any_value(length(text) - length(replace(text, chr(10), '')) + 1)::double end as lines
    from d group by id
""")
def embed_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of every third document have a vector of zeros already; the others are embedded."""
    docs = table(spark, sf_dir, "documents").select(T.sha256(F.col("text")).alias("id"), "text", "doc_id")
    old = docs.where("doc_id % 3 = 0").select("id").distinct().withColumn("embedding", F.array(*[F.lit(0.0).cast("float")] * 3))
    made = embed.embed(docs.select("id", "text"), measure, old)
    return made.select("id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(("bytes", "chars", "lines"))])


# Search


def _cosine_sql(tier: str) -> str:
    return f"""
        with {_STORE}, hits as (select q.vec_id as qid, s.id, s.source, s.tier, {_COS} as score from emb q, store s where q.vec_id % 50 = 0 {tier}),
        ranked as (select *, row_number() over (partition by qid order by score desc, id) as rank from hits)
        select qid, rank::int as rank, id, source, tier, round(score, 6) as score from ranked where rank <= 10
    """


def _cosine(spark: SparkSession, sf_dir: str, tier: str | None) -> DataFrame:
    queries = table(spark, sf_dir, "embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))
    return search.cosine(queries, _store(spark, sf_dir), 10, tier).select("qid", "rank", "id", "source", "tier", F.round("score", 6).alias("score"))


@query(_cosine_sql(""))
def cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cosine(spark, sf_dir, None)


@query("select count(*) as queries, true as good from embeddings where vec_id % 50 = 0 and exists (select 1 from documents)")
def approximate_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether approximate search finds 95 of 100 exact hits, over all queries of ``cosine_topk``."""
    rows = written(_store(spark, sf_dir).select("id", "embedding", "norm"), "store")
    queries = table(spark, sf_dir, "embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))
    found = CellIndex.write(rows, place(spark, "cells")).search(queries, 10)
    return nearby.recall(found, search.nearest(queries, rows, 10)).agg(F.count("*").alias("queries"), (F.avg("recall") >= 0.95).alias("good"))


@query(_cosine_sql("and s.tier = 'docs-wiki'"))
def cosine_topk_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cosine(spark, sf_dir, "docs-wiki")


_BM25 = f"""
    worded as (select lpad(doc_id::varchar, 12, '0') as id, {_WORDS.format("text")} as ts from documents),
    stats as (select count(*) as n, coalesce(avg(len(ts)), 0) as avgdl from worded),
    post as (select id, term, count(*) as tf, any_value(dl) as dl from (select id, len(ts) as dl, unnest(ts) as term from worded) group by id, term),
    terms as (select term, count(*) as df from post group by term),
    asked as (select item_id as qid, term, count(*) as qtf from (select item_id, unnest({_WORDS.format("text")}) as term from benchmark) group by item_id, term),
    scored as (select qid, id, sum(ln((n - df + 0.5) / (df + 0.5) + 1) * (tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * dl / greatest(avgdl, 1e-9))) * qtf order by a.term) as score
               from asked a join terms using (term) join post using (term), stats group by qid, id),
    bm25 as (select *, row_number() over (partition by qid order by round(score, 9) desc, id) as rank from scored)
"""


@query(f"with {_BM25} select qid, rank::int as rank, id, round(score, 6) as score from bm25 where rank <= 10")
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = search.Bm25(_as_chunks(table(spark, sf_dir, "documents")))
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))
    return words.search(queries, 10).select("qid", "rank", "id", F.round("score", 6).alias("score"))


@query(SQL["bm25_topk"])
def bm25_index_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from an inverted index that is written first: of its lists, those of the queries' words are read."""
    index = InvertedIndex.write(_as_chunks(table(spark, sf_dir, "documents")), place(spark, "index"))
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))
    return index.search(queries, 10).select("qid", "rank", "id", F.round("score", 6).alias("score"))


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("query"))
    return items.join(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector")), "qid")


def _hybrid_sql(before: str, after: str) -> str:
    return f"""
        with {_STORE}, {_BM25},
        dense as (select qid, id, source, row_number() over (partition by qid order by score desc, id) as r from
            (select b.item_id as qid, s.id, s.source, {_COS} as score from benchmark b join emb q on b.item_id = q.vec_id, store s {before})),
        words as (select b.qid, b.id, s.source, b.rank as r from bm25 b join store s on b.id = s.id join emb e on e.vec_id = b.qid where b.rank <= 20 {after}),
        d as (select qid, source, min(r) as r, arg_min(id, r) as id from dense where r <= 20 group by qid, source),
        w as (select qid, source, min(r) as r, arg_min(id, r) as id from words group by qid, source),
        fused as (select coalesce(d.qid, w.qid) as qid, coalesce(d.source, w.source) as source, coalesce(1.0::double / (60 + d.r), 0) + coalesce(1.0::double / (60 + w.r), 0) as score, coalesce(d.id, w.id) as id
                  from d full join w on d.qid = w.qid and d.source = w.source),
        top as (select *, row_number() over (partition by qid order by score desc, source) as rank from fused)
        select qid, rank::int as rank, id, source, round(score, 9) as score from top where rank <= 10
    """


def _hybrid(spark: SparkSession, sf_dir: str, tier: str | None) -> DataFrame:
    words = search.Bm25(_as_chunks(table(spark, sf_dir, "documents")))
    found = search.hybrid(_asked(spark, sf_dir), _store(spark, sf_dir), words, 10, tier)
    return found.select("qid", "rank", "id", "source", F.round("score", 9).alias("score"))


@query(_hybrid_sql("", ""))
def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hybrid(spark, sf_dir, None)


@query(_hybrid_sql("where s.tier = 'docs-wiki'", "and s.tier = 'docs-wiki'"))
def hybrid_topk_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hybrid(spark, sf_dir, "docs-wiki")


_NEEDLE = "regexp_extract(text, '^[^.]*')"
_FULLTEXT = f"""
    q as (select item_id as qid, {_trim(_NEEDLE)} as q from benchmark),
    f as (select doc_id || '.txt' as file, text from documents),
    hits as (select qid, file, (length(lower(text)) - length(replace(lower(text), lower(q), ''))) // length(q) as matches,
                    coalesce(list_filter(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)), lambda x: contains(lower(x), lower(q)))[1], '') as line
             from q, f where q <> '' and not contains(q, chr(10)) and contains(lower(text), lower(q)))
"""


@query(f"""
    with {_FULLTEXT} select qid, row_number() over (partition by qid order by matches desc, file)::int as rank, file, matches::bigint as matches,
        case when length({_trim("line")}) <= 240 then {_trim("line")} else left({_trim("line")}, 240) || '…' end as snippet from hits where matches > 0
""")
def fulltext_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first sentence of each benchmark item, looked for in all documents."""
    queries = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.regexp_extract("text", "^[^.]*", 0).alias("query"))
    files = table(spark, sf_dir, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file"), "text")
    return search.fulltext(queries, files)


# Evaluation


def _eval_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), "source")
    items = table(spark, sf_dir, "benchmark").join(own, "item_id")
    expected = F.array("source", F.concat(F.lit("src"), (F.col("item_id") * 7 % 23).cast("string")), F.lit("src0"))
    return items.select(F.col("item_id").alias("ord"), F.concat(F.lit("q"), F.col("item_id").cast("string")).alias("id"), F.col("text").alias("query"), expected.alias("expected"))


def _evaluated(spark: SparkSession, sf_dir: str, hybrid: bool) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"))
    add = lambda queries: queries.join(vectors, "qid")
    rows = _store(spark, sf_dir)
    strategy = evaluate.hybrid_docs(rows, search.Bm25(_as_chunks(table(spark, sf_dir, "documents"))), add) if hybrid else evaluate.cosine_docs(rows, add)
    return evaluate.run(_eval_set(spark, sf_dir), strategy)


_SET = "eval_set as (select b.item_id as ord, 'q' || b.item_id as id, b.text as query, [d.source, 'src' || (b.item_id * 7 % 23), 'src0'] as expected from benchmark b join documents d on d.doc_id = b.item_id)"
_COSINE_DOCS = f"""
    chunk_hits as (select qid, source, row_number() over (partition by qid order by score desc, id) as r from
        (select b.ord as qid, s.id, s.source, {_COS} as score from eval_set b join emb q on b.ord = q.vec_id, store s)),
    docs as (select qid, source as doc, row_number() over (partition by qid order by min(r)) as rank from chunk_hits where r <= 10 group by qid, source),
    hits as (select qid, list(doc order by rank) as hits from docs where rank <= 10 group by qid),
    scores as (select ord, id, query, coalesce(hits, []) as hits, len(list_filter(expected, lambda e: list_contains(coalesce(hits, [])[1:5], e))) / len(expected) as recall_5,
                      len(list_filter(expected, lambda e: list_contains(coalesce(hits, [])[1:10], e))) / len(expected) as recall_10 from eval_set left join hits on ord = qid)
"""


@query(f"with {_STORE}, {_SET}, {_COSINE_DOCS} select ord, id, query, array_to_string(hits, ',') as hits, round(recall_5, 9) as recall_5, round(recall_10, 9) as recall_10 from scores")
def eval_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _evaluated(spark, sf_dir, False)
    return found.select("ord", "id", "query", F.array_join("hits", ",").alias("hits"), F.round("recall_5", 9).alias("recall_5"), F.round("recall_10", 9).alias("recall_10"))


_DIGEST = """
    manifest as (select sha256('{' || chr(10) || '  "version": 1,' || chr(10) || '  "sources": [' || chr(10) || string_agg('    {' || chr(10) || '      "name": "' || name || '",' || chr(10)
        || '      "license": "MIT",' || chr(10) || '      "url": "' || url || '",' || chr(10) || '      "tier": "' || tier || '",' || chr(10) || '      "format": "' || format || '"' || chr(10) || '    }',
        ',' || chr(10) order by ord) || chr(10) || '  ]' || chr(10) || '}') as h from sources)
"""


@query(f"with {_STORE}, {_SET}, {_COSINE_DOCS}, {_SOURCES}, {_DIGEST} select 'cosine' as strategy, (select h from manifest) as corpus_hash, round(coalesce(avg(recall_5), 0), 9) as overall_recall_5, round(coalesce(avg(recall_10), 0), 9) as overall_recall_10 from scores")
def eval_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluate.overall(_evaluated(spark, sf_dir, False), "cosine", manifest.digest(manifest.to_json(_sources(spark, sf_dir))))
    return found.select("strategy", "corpus_hash", F.round("overall_recall_5", 9).alias("overall_recall_5"), F.round("overall_recall_10", 9).alias("overall_recall_10"))


_RECALL = "len(list_filter(expected, lambda e: list_contains(coalesce({0}, [])[1:{1}], e))) / len(expected)"


@query(f"""
    with {_STORE}, {_SET}, {_COSINE_DOCS},
    fused as (select qid, list(source order by rank) as found from ({_hybrid_sql("", "")}) group by qid),
    pair as (select {_RECALL.format("found", 5)} as f5, {_RECALL.format("found", 10)} as f10, recall_5, recall_10 from eval_set join scores using (ord) left join fused on eval_set.ord = fused.qid)
    select 'hybrid' as strategy, printf('%+.3f', avg(f5) - avg(recall_5)) as delta_5, printf('%+.3f', avg(f10) - avg(recall_10)) as delta_10 from pair
""")
def strategy_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far fusion is from cosine alone."""
    results = [evaluate.overall(_evaluated(spark, sf_dir, h), n) for h, n in ((True, "hybrid"), (False, "cosine"))]
    return evaluate.delta(*results)


@query(f"""
    with {_FULLTEXT}, ranked as (select qid, split_part(file, '.', 1) as doc, row_number() over (partition by qid order by matches desc, file) as rank from hits where matches > 0),
    best as (select qid, list(doc order by rank) as found from ranked where rank <= 10 group by qid),
    e as (select item_id as ord, [item_id::varchar, (item_id * 7 % 1000)::varchar] as expected from benchmark)
    select 'fulltext' as strategy, '' as corpus_hash, round(avg({_RECALL.format("found", 5)}), 9) as overall_recall_5, round(avg({_RECALL.format("found", 10)}), 9) as overall_recall_10 from e left join best on e.ord = best.qid
""")
def eval_fulltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the first sentence of an item finds the documents of two ids."""
    i = F.col("item_id")
    expected = F.array(i.cast("string"), (i * 7 % 1000).cast("string"))
    asked = table(spark, sf_dir, "benchmark").select(i.alias("ord"), i.cast("string").alias("id"), F.regexp_extract("text", "^[^.]*", 0).alias("query"), expected.alias("expected"))
    files = table(spark, sf_dir, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file"), "text")
    found = evaluate.overall(evaluate.run(asked, evaluate.fulltext_docs(lambda asked: search.fulltext(asked, files, k=evaluate.HITS))), "fulltext")
    return found.select("strategy", "corpus_hash", F.round("overall_recall_5", 9).alias("overall_recall_5"), F.round("overall_recall_10", 9).alias("overall_recall_10"))


@query("""
    with s as (select item_id as ord, 'q' || (item_id // 2) as id, case when item_id % 7 = 0 then ' ' else text end as query, case when item_id % 5 = 0 then [] else ['src0'] end as expected from benchmark),
    n as (select *, row_number() over (partition by id order by ord) as nth from s)
    select ord, 0 as kind, 'duplicate query id: ' || id as problem from n where nth > 1
    union all select ord, 1, 'query ' || id || ' has an empty needle' from n where trim(query) = ''
    union all select ord, 2, 'query ' || id || ' has an empty expected set' from n where len(expected) = 0
""")
def eval_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("item_id")
    expected = F.when(i % 5 == 0, F.expr("cast(array() as array<string>)")).otherwise(F.array(F.lit("src0")))
    rows = table(spark, sf_dir, "benchmark").select(i.alias("ord"), F.concat(F.lit("q"), F.floor(i / 2).cast("string")).alias("id"), F.when(i % 7 == 0, " ").otherwise(F.col("text")).alias("query"), expected.alias("expected"))
    return evaluate.problems(rows)


@query(f"with {_SET} select id, e as doc from (select id, unnest(expected) as e from eval_set) where e not in (select source from documents where source is not null)")
def eval_missing_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.missing(_eval_set(spark, sf_dir), table(spark, sf_dir, "documents").select(F.col("source").alias("name")).distinct())


# Prompts


def _literal(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _prompt_sql() -> str:
    head = _literal(prompt.HEAD).replace("{repo}", "demo").replace("{number}", "' || number || '").replace("{title}", "' || title || '")
    rules = _literal(prompt.RULES).replace("{number}", "' || number || '")
    return f"""
        with {_STORE}, issues as (select conv_id * 1000 + turn as number, conv_id, {_trim("role")} as title, {_trim("text")} as body from conversations where role = 'user'),
        hits as (select number, row_number() over (partition by number order by score desc, id) as rank, source, tier, text from
            (select i.number, s.id, s.source, s.tier, s.text, {_COS} as score from issues i join emb q on q.vec_id = i.conv_id, store s where i.conv_id % 50 = 0)),
        ctx as (select number, string_agg('[source: ' || source || ' | license: MIT | tier: ' || tier || ' | heading: ]' || chr(10) || text, chr(10) || chr(10) order by rank) as c from hits where rank <= 5 group by number)
        select number, {head} || {_literal(prompt.ISSUE_BEGIN)} || body || {_literal(prompt.ISSUE_END)}
            || coalesce(chr(10) || {_literal(prompt.CONTEXT_BEGIN)} || c || {_literal(prompt.CONTEXT_END)} || chr(10), '') || {rules} as prompt
        from issues left join ctx using (number)
    """


@query(_prompt_sql())
def rag_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn as an issue; those of every fiftieth conversation are grounded."""
    turns = table(spark, sf_dir, "conversations").where("role = 'user'")
    issues = turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("number"), "conv_id", F.col("role").alias("title"), F.col("text").alias("body"))
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("conv_id"), F.col("embedding").alias("vector"))
    asked = issues.where("conv_id % 50 = 0").join(vectors, "conv_id").select(F.col("number").alias("qid"), "vector")
    hits = search.cosine(asked, _store(spark, sf_dir), prompt.CONTEXT_CHUNKS)
    return prompt.build(issues.drop("conv_id"), "demo", hits)
