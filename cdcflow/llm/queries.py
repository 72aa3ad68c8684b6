"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.llm.filter_audit import audit
from cdcflow.llm.frames import saved, small_batches
from cdcflow.llm.imatch import fingerprint_edits
from cdcflow.llm.line_dedup import remove_repeats
from cdcflow.llm.line_runs import drop_common_lines
from cdcflow.llm.merkle import leaf_digest, manifest, small_letters
from cdcflow.llm.metric_search import top_by_inner_product
from cdcflow.llm.mixing import mix
from cdcflow.llm.ngram_join import similar_texts
from cdcflow.llm.packing import pack, token_pieces
from cdcflow.llm.quality import score, train
from cdcflow.llm.sharding import shards, text_size
from cdcflow.llm.suffix_dedup import remove_repeated_strings
from cdcflow.llm.url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

SPECIAL_TOKENS = {"<|endoftext|>": 50256}  # fixed by the vocabulary
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(small_batches(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    dealt = shards(docs, text_size(F.col("text")))
    return dealt.select(
        "row.doc_id",
        text_size(F.col("row.text")).alias("size"),
        F.crc32(F.coalesce("row.text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


NGRAM_SQL = """
with words as (
    select min(doc_id) over (partition by text) text_id, doc_id,
           list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '') w
    from documents),
texts as (select text_id, count(*) copies, any_value(w) w from words group by text_id),
grams as (
    select distinct text_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) g
    from texts),
sizes as (select text_id, count(*) n from grams group by text_id),
pairs as (
    select a.text_id a, b.text_id b, count(*) n_both from grams a join grams b on a.g = b.g and a.text_id <> b.text_id group by all),
links as (
    select p.a, p.b from pairs p join sizes x on x.text_id = p.a join sizes y on y.text_id = p.b
    where p.n_both * 1000000 >= 800000 * (x.n + y.n - p.n_both)),
counts as (
    select l.a, count(*) n_text_links, sum(t.copies) links from links l join texts t on t.text_id = l.b group by l.a),
reach as (
    with recursive r(node, reached) as (select text_id, text_id from texts union select r.node, l.b from r join links l on l.a = r.reached)
    select node, min(reached) class_id from r group by node)
select w.doc_id, r.class_id, w.text_id, cast(coalesce(c.links, 0) + t.copies - 1 as bigint) n_links, cast(coalesce(c.n_text_links, 0) as bigint) n_text_links
from words w join texts t using (text_id) join reach r on r.node = w.text_id left join counts c on c.a = w.text_id
"""


@query(NGRAM_SQL)
def op3_ngram_join(spark, sf_dir):
    return similar_texts(table(spark, sf_dir, "documents")).rows


@query()
def op5_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, SPECIAL_TOKENS)
    narrow = saved(pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "part", "nth"), "pieces")
    return pack(narrow)


URL_SQL = """
with parts as (
    select page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') path
    from pages),
rules(h, p, v) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit as (
    select page_id, arg_max(h || p, length(h || p)) "rule", arg_max(v, length(h || p)) v
    from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id)
select page_id, host, path, "rule", coalesce(v, 'allow') verdict from parts left join fit using (page_id)
"""


@query(URL_SQL)
def op10_url_filter(spark, sf_dir):
    judged = judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.withColumnRenamed("id", "page_id")


@query()
def op2_mixing(spark, sf_dir):
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    taken = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda total, p: total + p["words"])
    return mixed.select("row.doc_id", "size", "source_size", "target", taken.alias("taken"), "pieces")


@query()
def op7_line_dedup(spark, sf_dir):
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    return done.select(
        "row.doc_id",
        F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        "removed",
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


@query()
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query()
def op8_imatch(spark, sf_dir):
    return fingerprint_edits(table(spark, sf_dir, "documents"))


TOP_SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) e
    from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select q.vec_id query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) "rank", vec_id, score
from scored qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
"""


@query(TOP_SQL)
def op4_metric_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return top_by_inner_product(vectors, vectors.where("vec_id % 100 = 0")).withColumnRenamed("id", "vec_id")


@query()
def op9_suffix_dedup(spark, sf_dir):
    done = remove_repeated_strings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    return done.select(
        "row.doc_id",
        F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


AUDIT_SQL = """
with copies as (select coalesce(text, '') t, min(doc_id) least from documents group by all),
good as (select doc_id, max(cast(coalesce(quality = 1, false) as int)) good, max(cast(coalesce(toxic = 1, false) as int)) toxic from labels where doc_id is not null group by doc_id),
docs as (
    select coalesce(source, '') part, t, list_filter(regexp_split_to_array(t, '[ \\t-\\r]+'), lambda x: x <> '') w, coalesce(doc_id > least, false) e,
           coalesce(good, 0) good, coalesce(toxic, 0) toxic
    from documents join copies on t = coalesce(text, '') left join good using (doc_id)),
failures as (
    select part, good, toxic, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
           100 * (length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g'))) > 5 * length(t), regexp_matches(t, '[#$%&*|]'), e] f
    from docs),
cells as (select part, f, count(*) n, sum(good) good, sum(toxic) toxic from failures group by part, f),
letters(l) as (values (1), (2), (3), (4), (5)),
orders as (
    select [a.l, b.l, c.l, d.l, e.l] o from letters a, letters b, letters c, letters d, letters e
    where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps as (
    select o, l step, o[l] own, array_to_string(list_transform(o, lambda i: chr(64 + cast(i as int))), '') filter_order from orders, letters),
met as (
    select part, filter_order, step, own, n, good, toxic, f[own] fails,
           len(list_filter(o[1:step - 1], lambda i: f[i])) > 0 gone, len(list_filter(f, lambda x: x)) n_fails
    from cells, steps),
counts as (
    select part, filter_order, step, own,
           coalesce(sum(n) filter (not gone and not fails), 0) kept, coalesce(sum(n) filter (not gone and fails), 0) removed,
           coalesce(sum(n) filter (gone and fails), 0) redundant, coalesce(sum(n) filter (fails and n_fails = 1), 0) unique_fails,
           coalesce(sum(good) filter (not gone and fails), 0) good_lost, coalesce(sum(toxic) filter (not gone and fails), 0) toxic_lost
    from met group by part, filter_order, step, own)
select part, filter_order, cast(step as int) step, cast(kept as bigint) kept, cast(removed as bigint) removed, cast(redundant as bigint) redundant,
       cast(unique_fails as bigint) unique_fails, cast(good_lost as bigint) good_lost, cast(toxic_lost as bigint) toxic_lost,
       cast(sum(removed) over (partition by part, own) as bigint) shapley
from counts
"""


@query(AUDIT_SQL)
def op11_filter_audit(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


LINES_SQL = """
with lines as (
    select row_no, doc_id, unnest(l) line, unnest(range(len(l))) i
    from (select row_number() over () row_no, doc_id, string_split(coalesce(text, ''), chr(10)) l from documents)),
keyed as (
    select *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') key from lines),
common as (select key, max(doc_id) last from keyed where length(key) >= 40 group by key having count(distinct row_no) >= 5),
marked as (select k.*, c.key is not null and k.doc_id is distinct from c.last going from keyed k left join common c using (key))
select any_value(doc_id) doc_id, count(*) n_lines, count(*) filter (going) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not going), '')) kept_sha256
from marked group by row_no
"""


@query(LINES_SQL)
def op12_line_runs(spark, sf_dir):
    done = drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def _merkle_sql(levels: int = 12) -> str:
    """One step of SQL for each level, of the languages' trees and of the tree over them: enough for 8**12 rows."""

    def field(value: str) -> str:
        return f"coalesce(strlen(cast({value} as varchar)) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join([field(c) for c in ('doc_id', 'source', 'lang', 'n_chars')] + [field(text)])})"

    def tree(name: str, docs: str) -> str:
        """Nodes ``name``0 (grp, pos, h) and documents ``docs`` (n, grp, pos, x, proof), up to one node a group."""
        out = []
        for k in range(levels):
            run = "over (partition by grp, pos // 8 order by pos rows between"
            out.append(
                f"""{name}s{k} as (
    select *, count(*) over (partition by grp) c, coalesce(string_agg(h, '') {run} unbounded preceding and 1 preceding), '') l,
           coalesce(string_agg(h, '') {run} 1 following and unbounded following), '') r from {name}{k}),
{name}{k + 1} as (
    select grp, pos // 8 pos, case when any_value(c) = 1 then any_value(h) else sha256(string_agg(h, '' order by pos)) end h
    from {name}s{k} group by grp, pos // 8),
{docs}{name}{k + 1} as (
    select n, grp, pos // 8 pos, case when c = 1 then x else sha256(l || x || r) end x, case when c = 1 then proof else proof || l || r end proof
    from {docs}{name}{k} join {name}s{k} using (grp, pos))"""
            )
        return ",\n".join(out)

    return f"""
with recursive crc as (
    select distinct doc_id, cast(xor(list_reduce(
        list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda ch: cast(ascii(ch) as bigint))),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) as bigint) crc
    from documents where doc_id is not null),
docs as (
    select row_number() over (order by doc_id nulls first, {leaf('text')}) n, doc_id, lang, {leaf('text')} leaf,
           case when crc % 3 = 0 then {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} else {leaf('text')} end changed
    from documents left join crc using (doc_id)),
placed as (
    select *, dense_rank() over (order by lang nulls first) - 1 grp, row_number() over (partition by lang order by n) - 1 pos from docs),
a0 as (select grp, pos, leaf h from placed),
da0 as (select n, grp, pos, changed x, '' proof from placed),
{tree('a', 'd')},
b0 as (select 0 grp, grp pos, h from a{levels}),
db0 as (select n, 0 grp, grp pos, x, proof from da{levels}),
{tree('b', 'd')}
select doc_id, leaf, a.h subroot, b.h root, sha256(d.proof) proof_sha256, d.x folded_root, d.x = b.h verified
from placed p join a{levels} a on a.grp = p.grp join b{levels} b on true join db{levels} d on d.n = p.n
"""


@query(_merkle_sql())
def op13_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = docs.select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("part"),
        leaf_digest(*fields, F.col("text")).alias("node"),
        F.when(tampered, leaf_digest(*fields, small_letters(F.col("text")))).alias("changed"),
    )
    return manifest(rows).withColumnRenamed("id", "doc_id").withColumn("verified", F.col("folded_root") == F.col("root"))
