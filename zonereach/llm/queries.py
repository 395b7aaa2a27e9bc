"""The registered queries of the numbered operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import importance, toxicity
from .backoff import backoff_scores
from .base import Scratch, documents
from .centroids import cluster
from .chat import format_conversations, read_back
from .codes import TokenFiles
from .cover_tree import similarity_links
from .exact_dedup import DigestIndex, resolve
from .kd_shards import kd_shards
from .mixing import mix
from .packing import pack_documents
from .phrases import collocations
from .simhash import hex_digits, near_groups

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = 2
SHINGLE, RADIUS = 3, 2
COSINE = 0.93

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), Scratch(spark, "op1"), TOKENIZER, END, 1024)


@query("op2_kd_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards(documents(spark, sf_dir), Scratch(spark, "op2"), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op3_cover_tree_links",
    """
    with recursive usable as (
        select vec_id, label, embedding::double[] as v from embeddings
        where label is not null and len(embedding) = list_count(embedding)
            and isfinite(list_sum(embedding::double[])) and (list_max(embedding) <> 0 or list_min(embedding) <> 0)),
    links as (
        select a.vec_id as a, b.vec_id as b from usable a join usable b
            on a.label = b.label and a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.93),
    reached as (
        select vec_id as a, vec_id as b from embeddings
        union select r.a, l.b from reached r join links l on r.b = l.a)
    select e.vec_id, coalesce(any_value(d.n), 0)::bigint as n_links, min(r.b) as component_id, min(r.b) = e.vec_id as kept
    from embeddings e join reached r on r.a = e.vec_id
        left join (select a, count(*) as n from links group by a) d on d.a = e.vec_id
    group by e.vec_id
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Scratch(spark, "op3"), COSINE)


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.select(
        "doc_id",
        (toxicity.fold() == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "language",
    )


@query(
    "op5_source_mix",
    """
    with recursive sized as (
        select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
            -ln((cast('0x' || substr(md5('42:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint) + 0.5::double)
                / 4503599627370496.0::double)
            / coalesce((length(translate(text, '0123456789!#$%&*|{}<>=\\^~_+', '')) + 1)::double / (length(text) + 1), 1.0) as k
        from documents),
    sources as (
        select source, sum(size)::bigint as source_size,
            [5.0, 2.0, 1.0][((row_number() over (order by source is null, source) - 1) % 3 + 1)::int]::double as weight
        from sized group by source),
    -- The level is where a straight piece between two neighbouring sources meets the budget.
    filled as (
        select *, 2 * source_size / weight as full_at,
            sum(2 * source_size) over (order by 2 * source_size / weight, source rows unbounded preceding) as held,
            sum(weight) over () - sum(weight) over (order by 2 * source_size / weight, source rows unbounded preceding) as open_weight
        from sources),
    steps as (
        select full_at, held, open_weight from filled
        union all select 0, 0, (select sum(weight) from sources)),
    level as (
        select max((1.5 * (select sum(source_size) from sources) - held) / open_weight) as level
        from steps where open_weight > 0
            and (1.5 * (select sum(source_size) from sources) - held) / open_weight >= full_at),
    aims as (
        select source, source_size, round(least(source_size * 2.0::double, weight * (select level from level)), 6) as target
        from sources),
    placed as (
        select s.*, a.source_size, a.target,
            coalesce(sum(size) over (partition by s.source order by k, doc_id rows between unbounded preceding and 1 preceding), 0) as before,
            case when a.source_size > 0 then floor(a.target / a.source_size) else 0 end as whole
        from sized s join aims a on s.source is not distinct from a.source)
    select doc_id, size, source_size, target,
        cast(size * (whole + case when size > 0 and before + size / 2.0 < target - whole * source_size then 1 else 0 end) as bigint) as taken
    from placed
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir), Scratch(spark, "op5"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op6_simhash_groups")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(documents(spark, sf_dir), Scratch(spark, "op6"), SHINGLE, RADIUS)
    return groups.select("doc_id", hex_digits().alias("fingerprint"), "component_id")


@query(
    "op7_exact_dedup",
    """
    select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
        doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
    from documents window w as (partition by coalesce(text, ''))
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    index = DigestIndex.temporary(spark, expected=docs.count())
    found = resolve(index, docs, Scratch(spark, "op7"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op8_importance_resampling")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return importance.resample(docs, Scratch(spark, "op8"), importance.learn(docs, labels))


@query("op9_token_codes")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = TokenFiles(spark, Scratch(spark, "op9").path("tokens"))
    files.write(documents(spark, sf_dir), TOKENIZER, END)
    return files.documents().select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op10_backoff_scores")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(documents(spark, sf_dir))


@query(
    "op11_phrase_collocations",
    """
    with pieces as (
        select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from (
            select coalesce(lang, 'und') as lang,
                unnest(regexp_split_to_array(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
            from documents where text is not null)),
    placed as (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces),
    grams as (
        select lang, w[i] as phrase, 1 as words from placed
        union all select lang, w[i] || ' ' || w[i + 1], 2 from placed where i + 1 <= len(w)
        union all select lang, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2], 3 from placed where i + 2 <= len(w)),
    counts as (select lang, phrase, words, count(*) as f from grams group by all),
    totals as (select lang, cast(sum(f) as bigint) as n from counts where words = 1 group by lang),
    candidates as (select lang, phrase, string_split(phrase, ' ') as w, words, f as a from counts where words > 1 and f >= 10),
    cuts as (
        select lang, phrase, a, k, array_to_string(w[:k], ' ') as left_part, array_to_string(w[k + 1:], ' ') as right_part
        from (select *, unnest(range(1, words)) as k from candidates)),
    scored as (
        select c.*, p.f as l, q.f as r, (1000000::hugeint * a * a) // (p.f::hugeint * q.f) as score
        from cuts c join counts p on p.lang = c.lang and p.phrase = c.left_part
            join counts q on q.lang = c.lang and q.phrase = c.right_part),
    best as (
        select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    inner_phrases as (
        select lang, unnest([array_to_string(w[:2], ' '), array_to_string(w[2:], ' ')]) as phrase, a from candidates where words = 3),
    kept as (
        select * from best b
        where not exists (select 1 from inner_phrases i where i.lang = b.lang and i.phrase = b.phrase and 100 * i.a >= 50 * b.a)),
    ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
    select lang, rank, phrase, a, l, r, n, cast(score as bigint) as score
    from ranked join totals using (lang) where rank <= 2000
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir), Scratch(spark, "op11"))


CONTROL_CHAT = "</s>[INST] ok [/INST]"


@query(
    "op12_chat_masks",
    """
    with turns as (
        select conv_id, turn, role, coalesce(text, '') as text from conversations
        union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    rendered as (
        select *, 17 + length(role) + length(regexp_replace(text,
            '(<)(\\\\*(?:/s>|\\|endoftext\\|>))|(\\[)(\\\\*(?:INST\\]|/INST\\]))', '\\1\\3\\\\\\2\\4', 'g')) as chars
        from turns)
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
        coalesce(cast(sum(length(text)) filter (where role = 'assistant') as bigint), 0) as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) as loss_sha256,
        cast(sum(chars) as bigint) as formatted_chars
    from rendered group by conv_id
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_CHAT), (-1, 1, "assistant", CONTROL_CHAT)], rows.schema)
    return read_back(format_conversations(rows.unionByName(extra), Scratch(spark, "op12"), TOKENIZER))


@query(
    "op13_centroid_clusters",
    """
    with kept as (
        select vec_id, row_number() over () as n, list_transform(embedding, lambda x: cast(floor(64 * x::double) as bigint)) as v
        from embeddings
        where len(embedding) = 64 and list_count(embedding) = 64
            and len(list_filter(embedding, lambda x: isfinite(x))) = 64),
    c0 as (
        select row_number() over (order by sha256('1:' || vec_id), v) - 1 as cluster, v
        from kept order by sha256('1:' || vec_id), v limit 16),
    near1 as (
        select k.n, arg_min(c.cluster, (list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cluster)) as cluster
        from kept k, c0 c group by k.n),
    sums1 as (
        select cluster, pos, sum(x) as s, count(*) as m
        from (select near1.cluster, unnest(k.v) as x, generate_subscripts(k.v, 1) as pos from near1 join kept k using (n)) group by cluster, pos),
    c1 as (
        select c.cluster, coalesce(m.v, c.v) as v from c0 c left join (
            select cluster, list(cast((s - ((s % m) + m) % m) // m as bigint) order by pos) as v from sums1 group by cluster) m using (cluster)),
    near2 as (
        select k.n, arg_min(c.cluster, (list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cluster)) as cluster
        from kept k, c1 c group by k.n),
    sums2 as (
        select cluster, pos, sum(x) as s, count(*) as m
        from (select near2.cluster, unnest(k.v) as x, generate_subscripts(k.v, 1) as pos from near2 join kept k using (n)) group by cluster, pos),
    c2 as (
        select c.cluster, coalesce(m.v, c.v) as v from c1 c left join (
            select cluster, list(cast((s - ((s % m) + m) % m) // m as bigint) order by pos) as v from sums2 group by cluster) m using (cluster)),
    near3 as (
        select k.n, arg_min(c.cluster, (list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cluster)) as cluster
        from kept k, c2 c group by k.n),
    sums3 as (
        select cluster, pos, sum(x) as s, count(*) as m
        from (select near3.cluster, unnest(k.v) as x, generate_subscripts(k.v, 1) as pos from near3 join kept k using (n)) group by cluster, pos),
    c3 as (
        select c.cluster, coalesce(m.v, c.v) as v from c2 c left join (
            select cluster, list(cast((s - ((s % m) + m) % m) // m as bigint) order by pos) as v from sums3 group by cluster) m using (cluster)),
    assigned as (
        select k.vec_id, min((list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cluster)) as best
        from kept k, c3 c group by k.n, k.vec_id)
    select vec_id, cast(best[2] as int) as cluster, cast(best[1] as bigint) as distance,
        cast(sum(best[1]) over (partition by best[2]) as bigint) as cluster_inertia, cast(sum(best[1]) over () as bigint) as inertia,
        (select sha256(array_to_string(v, ',')) from c3 where c3.cluster = best[2]) as centroid_sha256
    from assigned
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Scratch(spark, "op13"))
