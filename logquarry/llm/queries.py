"""One query per operator over the given tables, and their checks in SQL for another engine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.llm import (
    chat,
    checks,
    exact_dedup,
    langid,
    mixing,
    packing,
    repair,
    secret_scan,
    sharding,
    simhash,
    spelling,
    substring,
    topk,
    toxicity,
)
from logquarry.llm.common import held_out, text_of
from logquarry.plans.workspace import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    """The public tokenizer file that the packing query uses; executors have it installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One half of the documents, by a hash of the id, is the snapshot; the other arrives."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    arrives = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    return exact_dedup.exact_dedup(docs.filter(arrives), docs.filter(~arrives))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("text_hash", "copies")


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(langid.training_rows(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents are dealt, written, and read back from their shards."""
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long")
    sharded = sharding.shuffled_shards(table(spark, sf_dir, "documents").withColumn("size", size))
    path = shared_folder(spark, "shards")
    sharding.write_shards(sharded, path)
    key = F.col("doc_id")
    return spark.read.schema(sharded.schema).parquet(path).select(
        "doc_id",
        size.alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        sharding.shard_of(key, sharding.SHARDS + 1).alias("grown_shard"),
    )


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted"
    )


@query
def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed ids themselves give their check sum."""
    rows = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=True)
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


@query
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


@query
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.find_secrets(docs, secret_scan.fit(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{name}") for i, name in enumerate(secret_scan.KINDS[:3])],
        F.sha2(secret_scan.spans_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.spans_text(F.concat("base", "added")).alias("spans"),
    )


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


ORACLE_SQL = {
    "op13_spelling": checks.SPELLING,
    "op11_repair": checks.REPAIR,
    "op1_topk": """
        with vectors as (
          select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
          from embeddings
          where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
          select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
          from vectors q join vectors c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
        ranked as (
          select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank,
                 vec_id, score from scored)
        select query_id, cast(rank as int) as rank, vec_id, score from ranked where rank <= 20
    """,
    "op5_chat": """
        with convs as (
          select conv_id, count(*) as n_turns,
                 list({'role': role, 'text': text} order by turn, role, text) as turns
          from conversations group by conv_id),
        prefixes as (
          select distinct turns[1:n] as prefix
          from (select turns, unnest(range(1, n_turns)) as n from convs)),
        distinct_convs as (
          select min(conv_id) as conv_id, n_turns, turns, count(*) as snapshots
          from convs group by n_turns, turns)
        select conv_id, n_turns, snapshots,
               array_to_string(list_transform(turns, lambda t:
                 '<|im_start|>' || coalesce(t.role, 'unknown') || chr(10) || coalesce(t.text, '')
                 || '<|im_end|>' || chr(10)), '') as chat
        from distinct_convs d where not exists (select 1 from prefixes p where p.prefix = d.turns)
    """,
    "op8_substring": """
        with texts as (
          select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words
          from documents),
        windows as (
          select doc_id, i, array_to_string(words[i:i + 34], ' ') as run
          from (select doc_id, words, unnest(range(1, len(words) - 33)) as i from texts)),
        repeats as (
          select doc_id, i from windows qualify count(*) over (partition by run) > 1),
        removed as (select distinct doc_id, unnest(range(i, i + 35)) as word from repeats),
        gone as (select doc_id, list(word) as gone from removed group by doc_id)
        select t.doc_id, len(words) as n_words, len(coalesce(gone, [])) as n_removed,
               sha256(array_to_string(
                 [words[j] for j in range(1, len(words) + 1) if not list_contains(coalesce(gone, []), j)],
                 ' ')) as kept_sha256
        from texts t left join gone using (doc_id)
    """,
    "op2_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
        from documents window same as (partition by coalesce(text, ''))
    """,
    "op3_mixing": """
        with sized as (
          select doc_id, source,
                 md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))) as key,
                 len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size
          from documents),
        sources as (
          select source, sum(size) as source_size,
                 row_number() over (order by encode(source) nulls last) as source_rank
          from sized group by source),
        listed as (
          select *, (source_rank - 1) % 3 + 1 as weight, 3 * source_size as size_limit from sources),
        placed as (
          select *, row_number() over filling as place,
                 sum(source_size) over () - coalesce(sum(size_limit) over filled, 0) as rest_size,
                 sum(weight) over () - coalesce(sum(weight) over filled, 0) as rest_weight
          from listed
          window filling as (order by size_limit / weight, source_rank),
                 filled as (order by size_limit / weight, source_rank
                            rows between unbounded preceding and 1 preceding)),
        first_free as (
          select * from placed
          where size_limit > cast(rest_size as double) * weight / rest_weight
          order by place limit 1),
        targets as (
          select p.source, p.source_size, p.source_rank,
                 case when p.place >= f.place
                      then cast(f.rest_size as double) * p.weight / f.rest_weight
                      else cast(p.size_limit as double) end as target
          from placed p left join first_free f on true),
        queued as (
          select s.*, t.source_size, t.source_rank, t.target,
                 sum(s.size) over (partition by s.source order by s.key, s.doc_id, s.size
                                   rows unbounded preceding) as words_to
          from sized s join targets t on s.source is not distinct from t.source),
        copies as (
          select *, case when target > 0
                         then cast(source_size * epoch + words_to as double) / target end as finish
          from queued, (values (0), (1), (2)) e(epoch)),
        ordered as (
          select *, sum(size) over (order by finish nulls last, source_rank, key
                                    rows unbounded preceding) as words
          from copies where size > 0),
        taken as (
          select doc_id, key, count(*) as n, min(words - size) as position from ordered
          where words <= (select sum(size) from sized) group by doc_id, key)
        select q.doc_id, q.size, cast(q.source_size as bigint) as source_size, q.target,
               cast(q.size * coalesce(t.n, 0) as bigint) as taken, cast(t.position as bigint) as position
        from queued q left join taken t on q.key = t.key and q.size > 0
    """,
}
