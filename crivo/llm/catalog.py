"""Registered queries of the corpus operators, with the SQL that must give the same rows where SQL can say it.

Every query applies its operator with production parameters to whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crivo.llm import bpe, exact, fingerprint, licenses, merkle, mix, near, planes, quality, repeats, secrets, shards, spelling
from crivo.llm.base import LOWER, UPPER, WORD, normalised, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def query(name: str, sql: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


NORMALISED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(table(spark, folder, "documents"), tokens, public_tokenizers.PATTERN, ["doc_id"])


@query(
    "op2_exact_dedup",
    f"""with hashed as (select doc_id, sha256({NORMALISED}) as text_sha256 from documents)
    select doc_id, max(doc_id) over (partition by text_sha256) as keep_id,
        count(*) over (partition by text_sha256) as group_size,
        doc_id = max(doc_id) over (partition by text_sha256) as kept, text_sha256
    from hashed""",
)
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_dedup(table(spark, folder, "documents"))


# Brute force: all pairs of documents that share a shingle, then the smallest id reachable.
NEAR_SQL = f"""with recursive tokens as (
        select doc_id, list_filter(regexp_split_to_array({NORMALISED}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as words
        from documents),
    sets as (
        select doc_id, case when len(words) = 0 then []::varchar[]
            when len(words) < 4 then [array_to_string(words, ' ')]
            else list_distinct(list_transform(list_zip(words[:len(words) - 3], words[2:len(words) - 2], words[3:len(words) - 1],
                words[4:]), lambda s: s[1] || ' ' || s[2] || ' ' || s[3] || ' ' || s[4])) end as shingles
        from tokens),
    long as (select doc_id, unnest(shingles) as shingle, len(shingles) as n from sets),
    links as (
        select a.doc_id as a, b.doc_id as b from long a join long b on a.shingle = b.shingle and a.doc_id <> b.doc_id
        group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    reach(doc_id, hit) as (
        select doc_id, doc_id from sets union select r.doc_id, l.b from reach r join links l on r.hit = l.a)
    select s.doc_id, len(shingles)::bigint as n_shingles, min(hit) as component_id, s.doc_id = min(hit) as kept
    from sets s join reach r on s.doc_id = r.doc_id group by s.doc_id, shingles"""


@query("op3_near_dedup", NEAR_SQL)
def op3_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_groups(table(spark, folder, "documents"))


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op5_sharding")
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard(table(spark, folder, "documents"))


# The level of the water: with the sources in the order in which they fill up, the first one that leaves the next
# source room.
MIX_SQL = f"""with sized as (
        select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) as size, md5(doc_id::varchar) as key
        from documents),
    sources as (
        select source, sum(size)::bigint as source_size,
            ((row_number() over (order by source nulls last) - 1) % 3 + 1) as weight
        from sized group by source),
    filling as (
        select *, sum(source_size) over () as total,
            coalesce(sum(3 * source_size) over (order by 3.0::double * source_size / weight, source nulls last
                rows between unbounded preceding and 1 preceding), 0) as capped,
            sum(weight) over (order by 3.0::double * source_size / weight, source nulls last
                rows between current row and unbounded following) as left_weight
        from sources),
    level as (select arg_min((total - capped)::double / left_weight, 3.0::double * source_size / weight) as l from filling
        where (total - capped)::double / left_weight <= 3.0::double * source_size / weight),
    wanted as (
        select source, source_size, least(3.0::double * source_size, weight * coalesce(l, 0)) as target
        from sources left join level on true),
    budgets as (
        select *, floor(target + 0.5)::bigint as budget, case when source_size = 0 then 0
            else floor(target + 0.5)::bigint // source_size end as epochs from wanted),
    placed as (
        select doc_id, s.source, size, source_size, target, epochs, budget - epochs * source_size as rest,
            sum(size) over (partition by s.source order by key) - size as before
        from sized s join budgets b on s.source is not distinct from b.source)
    select doc_id, size::bigint as size, source_size, round(target, 6) as target,
        (epochs * size + greatest(0, least(size, rest - before)))::bigint as taken
    from placed"""


@query("op6_mixing", MIX_SQL)
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix.mix(table(spark, folder, "documents"))


@query("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edits(table(spark, folder, "documents"))


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


@query("op9_token_file")
def op9_token_file(spark: SparkSession, folder: str) -> DataFrame:
    root = planes.new_folder(spark)
    tokenizer = planes.read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    planes.write(table(spark, folder, "documents"), root, tokenizer, end=1)
    return planes.digests(spark, root)


@query("op10_license_scan", licenses.sql(upper=UPPER, lower=LOWER))
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query("op10_license_whole", licenses.whole_sql(upper=UPPER, lower=LOWER))
def op10_license_whole(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.whole(table(spark, folder, "documents"))


# Brute force: every string of 100 bytes, as hex.
REPEATS_SQL = """with bytes as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
    strings as (select doc_id, i, substr(h, 2 * i + 1, 200) as s from (select *, unnest(range(0, n - 99)) as i from bytes)),
    later as (select doc_id, i from strings qualify row_number() over (partition by s order by doc_id, i) > 1),
    breaks as (select *, case when i - lag(i) over (partition by doc_id order by i) <= 100 then 0 else 1 end as new from later),
    islands as (select *, sum(new) over (partition by doc_id order by i) as island from breaks),
    spans as (select doc_id, min(i) as b, max(i) + 100 as e, lag(max(i) + 100, 1, 0) over (partition by doc_id order by min(i)) as a
        from islands group by doc_id, island),
    kept as (select s.doc_id, sum(e - b) as n_removed, count(*) as n_spans,
            string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' order by b) || substr(any_value(h), 2 * max(e) + 1) as k
        from spans s join bytes on bytes.doc_id = s.doc_id group by s.doc_id)
    select bytes.doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
        sha256(unhex(coalesce(k, h))) as kept_sha256
    from bytes left join kept on kept.doc_id = bytes.doc_id"""


@query("op11_repeated_strings", REPEATS_SQL)
def op11_repeated_strings(spark: SparkSession, folder: str) -> DataFrame:
    told = repeats.without_repeats(table(spark, folder, "documents"))
    return told.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


# crc32 of a list of bytes, through the table of the 256 bytes; of the text that DuckDB writes.
CRC_SQL = """crc(t) as (select list(list_reduce(list_prepend(b, [0,0,0,0,0,0,0,0]::bigint[]),
            lambda x, y: xor(x >> 1, case when x & 1 = 1 then 3988292384 else 0 end)) order by b) from range(256) r(b))"""


def crc_sql(text: str, table: str = "t") -> str:
    """SQL for the unsigned crc32 of a text expression, given the table of `crc`."""
    octets = f"list_transform(range(0, strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint)"
    return f"""xor(list_reduce(list_prepend(4294967295::bigint, {octets}),
        lambda c, o: xor(c >> 8, {table}[1 + (xor(c, o) & 255)])), 4294967295)"""


# Brute force: every pair of words of like length. Letters become one byte each, so that a byte is a code point.
LATIN = "".join(map(chr, range(0xC0, 0x100)))
SINGLE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789!#$%&()*+,-./:;<=>?@[]^_{|}~"
SPELLING_SQL = f"""with recursive {CRC_SQL},
    runs as (select doc_id, unnest(regexp_extract_all({NORMALISED}, '[A-Za-z\u00C0-\u00FF]+')) as run from documents),
    hashed as (select run, count(*) as times, {crc_sql("(doc_id::varchar || ':' || run)", "any_value(t)")} as h
        from (select doc_id, run, t from runs, crc) group by doc_id, run),
    written as (select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
        else run end as word, times from hashed),
    words as (select word, sum(times)::bigint as n, translate(word, '{LATIN}', '{SINGLE}') as code from written
        where length(word) >= 5 group by word having sum(times) >= 3),
    near as (select a.word, b.word as other, b.n as other_n from words a join words b
        on length(b.code) between length(a.code) - 1 and length(a.code) + 1 and levenshtein(a.code, b.code) = 1),
    ranked as (select *, count(*) over (partition by word) as n_near,
        row_number() over (partition by word order by other_n desc, other) as place from near),
    formed as (select w.word, w.n, coalesce(r.n_near, 0)::bigint as n_near, case when r.other_n >= 2 * w.n then r.other end as form,
        case when r.other_n >= 2 * w.n then r.other_n end as form_n
        from words w left join ranked r on r.word = w.word and r.place = 1),
    chain as (select word, coalesce(form, word) as root, form is null as done from formed
        union all select c.word, coalesce(f.form, c.root), f.form is null
        from chain c join formed f on f.word = c.root where not c.done)
    select f.*, c.root from formed f join chain c on c.word = f.word and c.done"""


@query("op12_spelling_variants", SPELLING_SQL)
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def _field(name: str, text: str) -> str:
    return f"case when {name} is null then '-' else strlen({text})::varchar || ':' || {text} end"


def _leaf_sql(text: str) -> str:
    plain = " || ".join(_field(c, f"{c}::varchar") for c in ("doc_id", "source", "lang", "n_chars"))
    return f"sha256({plain} || {_field('text', text)})"


# Every level of a tree is a list of nodes; siblings are read off the lists.
MERKLE_SQL = f"""with recursive {CRC_SQL},
    leaves as (select doc_id, lang, {_leaf_sql("text")} as leaf,
            case when {crc_sql("doc_id::varchar")} % 3 = 0 then {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")}
                else {_leaf_sql("text")} end as seen,
            row_number() over (partition by lang order by doc_id) - 1 as place from documents, crc),
    levels as (
        select lang, 0 as level, list(leaf order by place) as nodes from leaves group by lang
        union all
        select lang, level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
        from levels where len(nodes) > 1),
    subroots as (select lang, nodes[1] as subroot, row_number() over (order by lang nulls first) - 1 as rank
        from levels where len(nodes) = 1),
    tops as (
        select 0 as level, list(subroot order by rank) as nodes from subroots
        union all
        select level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
        from tops where len(nodes) > 1),
    root as (select nodes[1] as root from tops where len(nodes) = 1),
    steps as (
        select l.doc_id, v.level, v.nodes, l.place // (8 ** v.level)::bigint as p from leaves l join levels v
            on v.lang is not distinct from l.lang and len(v.nodes) > 1
        union all
        select l.doc_id, 1000 + t.level, t.nodes, s.rank // (8 ** t.level)::bigint from leaves l join subroots s
            on s.lang is not distinct from l.lang join tops t on len(t.nodes) > 1),
    sides as (select doc_id, level, array_to_string(nodes[p // 8 * 8 + 1:p], '') as l, array_to_string(nodes[p + 2:p // 8 * 8 + 8], '') as r
        from steps),
    proofs as (select doc_id, list([l, r] order by level) as path from sides group by doc_id),
    told as (select l.doc_id, l.leaf, s.subroot, root.root, sha256(array_to_string(flatten(coalesce(path, [])), '')) as proof_sha256,
            list_reduce(list_prepend([seen], coalesce(path, [])), lambda d, x: [sha256(x[1] || d[1] || x[2])])[1] as folded_root
        from leaves l join subroots s on s.lang is not distinct from l.lang cross join root left join proofs p on p.doc_id = l.doc_id)
    select *, folded_root = root as verified from told"""


@query("op13_merkle_manifest", MERKLE_SQL)
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.manifest(docs, {"text": F.when(tampered, normalised(F.col("text"))).otherwise(F.col("text"))})


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
