"""The operators of this subpackage as queries over the given tables.

``QUERIES[name](spark, sf_dir)`` applies one operator to its whole table; ``ORACLE_SQL`` has
DuckDB SQL for those that SQL can express over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocations, decontam, neardup, pivot_topk, prefix_trie, quality_cnn, secret_scan,
               sentencepiece_np, shards, token_files, token_tree, toxicity, warc)
from .common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ship(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return add


# ------------------------------------------------------------------ 1 WARC
OP1_SQL = """
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
h as (select page_id, octet_length(body) as payload_bytes, sha1(body) as hex from p),
d as (select *, array_to_string(list_transform(range(0, 8), lambda i:
        array_to_string(list_transform([15, 10, 5, 0], lambda s:
          substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 ((('0x' || substr(hex, 5 * i + 1, 5))::bigint >> s) & 31)::int + 1, 1)), '')), '')
      as payload_digest, max(page_id) over (partition by hex) as most from h)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
       case when most is null or page_id = most then 'response' else 'revisit' end as record_type,
       case when page_id = most then null else most end as refers_to
from d
"""


@query("op1_warc", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive of all pages, read back and indexed. The table has no capture time: one
    second per page id stands in for it."""
    pages = table(spark, sf_dir, "pages").withColumn(
        "captured_at", F.timestamp_seconds(1_600_000_000 + F.coalesce("page_id", F.lit(0))))
    index = warc.archive_and_index(pages)
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast("long")
    return index.select(number("key").alias("page_id"), "payload_bytes", "payload_digest",
                        "record_type", number("refers_to").alias("refers_to"))


# ------------------------------------------------------------------ 2 SentencePiece
@query("op2_sentencepiece")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text, and whether decoding gives the text back."""
    return sentencepiece_np.encode(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 3 secrets
def _op3_sql() -> str:
    per_kind = " union all ".join(
        f"""select row, owner, {k} as k, '{name}' as kind, {least} as least,
        regexp_extract_all(t, '{p}', 0) as m, regexp_extract_all(t, '{p}', {group}) as v,
        list_transform(string_split_regex(t, '{p}'), lambda x: length(x)) as gaps
        from d where regexp_matches(t, '{p}')"""
        for k, (name, pattern, group, least) in enumerate(secret_scan.KINDS)
        for p in [pattern.replace("'", "''")])
    hold = secret_scan.PLACEHOLDER
    return f"""
with d as (select row_number() over () as row, doc_id, coalesce(text, '') as t,
           coalesce(source, '') as owner from documents),
k as ({per_kind}),
e as (select row, owner, k, kind, least, gaps, m, unnest(range(1, len(m) + 1)) as i, v from k),
s as (select row, owner, k, kind, v[i] as value,
      list_sum(gaps[1:i]) + list_sum(list_transform(m[1:i], lambda x: length(x))) as stop, length(m[i]) as size
      from e where length(v[i]) >= least),
o as (select value, count(distinct owner) as owners from s group by value),
j as (select row, k, kind, (stop - size)::bigint as start, stop::bigint as stop,
      case when owners >= {secret_scan.COPIED_OWNERS} then 'copied'
           when regexp_matches(value, '{hold}')
             or len(list_distinct(string_split(value, ''))) < {secret_scan.LIVE_CHARACTERS} then 'placeholder'
           else 'live' end as verdict from s join o using (value)),
g as (select row, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access,
      count(*) filter (k = 2) as n_hex, count(*) filter (verdict = 'live') as n_live,
      count(*) filter (verdict = 'copied') as n_copied,
      count(*) filter (verdict = 'placeholder') as n_placeholder,
      string_agg(kind || ':' || start || ':' || stop, ',' order by start, k) as spans,
      string_agg(kind || ':' || start || ':' || stop, ',' order by start, k) filter (k < 3) as base
      from j group by row)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
       coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
       coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live,
       coalesce(n_copied, 0) as n_copied, coalesce(n_placeholder, 0) as n_placeholder
from d left join g using (row)
"""


@query("op3_secrets", _op3_sql())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document. The table's source stands in for owner and repository."""
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied",
        "n_placeholder")


# ------------------------------------------------------------------ 4 quality
def _remainder(column: str, by: int):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(by))


def quality_weights(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Weights of the quality classifier, learned outside the held-out rows."""
    return quality_cnn.fit(docs, table(spark, sf_dir, "labels"), may_learn=_remainder("id", 4) != 2)


@query("op4_quality")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_cnn.score(docs, quality_weights(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


# ------------------------------------------------------------------ 5 shards
@query("op5_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes."""
    return shards.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"), "tokens")


# ------------------------------------------------------------------ 6 near duplicates
@query("op6_neardup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


# ------------------------------------------------------------------ 7 exact top-k
OP7_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(x::double * 256)) as v from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, x.vec_id, list_dot_product(q.v, x.v)::bigint as score
      from v q, v x where q.vec_id % 50 = 0 and q.vec_id <> x.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5
"""


@query("op7_topk", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


# ------------------------------------------------------------------ 8 toxicity
@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"), may_learn=_remainder("id", 5) != 0)
    return toxicity.score(docs, weights).select(
        "doc_id", F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


# ------------------------------------------------------------------ 9 token counts
@query("op9_tokencounts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after two edits each. The tables hold no
    edits; each document gets a replacement in its first half and an insertion in its
    second."""
    n, text = F.length("text"), F.col("text")
    at = lambda share: F.floor(n * share).cast("int")
    edits = F.array(
        F.struct(at(0.3).alias("start"), (at(0.3) + 12).alias("end"), F.substring(text, 1, 24).alias("replacement")),
        F.struct(at(0.7).alias("start"), at(0.7).alias("end"), F.concat(F.lit(" "), F.coalesce("source", F.lit("")))
                 .alias("replacement")))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", edits.alias("edits"))
    counted = token_tree.apply_edits(token_tree.build(docs, more=("edits",)), keep_state=False)
    return counted.select(F.col("id").alias("doc_id"), "n_tokens_before", "n_tokens", "n_edits", "n_encoded")


# ------------------------------------------------------------------ 10 decontamination
@query("op10_decontamination")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that lie in them."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# ------------------------------------------------------------------ 11 token-id files
@query("op11_tokenfiles")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text in files with Elias-Fano boundaries, read back."""
    return token_files.write_and_read(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


# ------------------------------------------------------------------ 12 collocations
OP12_SQL = f"""
with d as (select row_number() over () as doc, coalesce(lang, '{collocations.UNKNOWN_LANG}') as lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
           from documents),
p as (select doc, lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) as piece from d),
q as (select row_number() over () as piece, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from p),
o as (select lang, w, len(w) as size, unnest(range(1, len(w) + 1)) as i from q),
n as (select lang, count(*) as n from o group by lang),
g as (select lang, w[i:i + k - 1] as g, count(*) as f from o, (select unnest([1, 2, 3, 4]) as k)
      where i + k - 1 <= size group by all),
c as (select lang, g, f from g where len(g) >= 2 and f >= {collocations.LEAST}),
k as (select lang, g, f, unnest(range(1, len(g))) as k from c),
s as (select k.lang, k.g, k.f, k.k, x.f as l, y.f as r, k.f::hugeint * 2000000 // (x.f + y.f) as score
      from k join g x on x.lang = k.lang and x.g = k.g[1:k.k]
             join g y on y.lang = k.lang and y.g = k.g[k.k + 1:]),
b as (select lang, g, f, unnest(min(struct_pack(score := score, k := k, l := l, r := r))) from s group by lang, g, f),
i as (select lang, f, g, unnest(range(1, len(g))) as i from c where len(g) >= 3),
j as (select lang, f, g, i, unnest(range(i + 1, len(g) + 1)) as j from i),
h as (select lang, g[i:j] as g, max(f) as longer from j where j - i + 1 < len(g) group by all),
r as (select b.lang, array_to_string(b.g, ' ') as phrase, b.f as a, b.l, b.r, b.score,
      row_number() over (partition by b.lang order by b.score desc, b.f desc, array_to_string(b.g, ' ')) as rank
      from b left join h on h.lang = b.lang and h.g = b.g
      where h.longer is null or 100 * h.longer < 80 * b.f)
select r.lang, r.rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r.r::bigint as r, n.n::bigint as n,
       score::bigint as score from r join n on n.lang = r.lang where rank <= {collocations.TOP}
"""


@query("op12_collocations", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two to four words of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 13 prefix trie
OP13_SQL = """
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations
           where conv_id is not null),
o as (select conv_id, role, text, row_number() over (partition by conv_id order by turn nulls first,
      md5(length(role) || ':' || role || text)) as k from t),
c as (select conv_id, conv_id - conv_id % 100 as base, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
        lambda r, x: list_reduce(list_prepend(xor(r, x), range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))),
        4294967295::bigint) % 6 as h from (select distinct conv_id from o)),
b as (select conv_id, count(*) as there from o group by conv_id),
x as (select c.conv_id, c.base, c.h, least(c.h, coalesce(b.there, 0)) as taken from c left join b on b.conv_id = c.base),
s as (select x.conv_id, o.k as d, o.role, o.text from x join o on o.conv_id = x.base and o.k <= x.taken
      union all select x.conv_id, x.taken + o.k - x.h, o.role, o.text from x join o on o.conv_id = x.conv_id and o.k > x.h),
q as (select x.conv_id, coalesce(list({'role': s.role, 'text': s.text} order by s.d) filter (s.d is not null), []) as seq
      from x left join s using (conv_id) group by x.conv_id),
p as (select conv_id, len(seq) as size, unnest(range(0, len(seq) + 1)) as d, seq from q),
m as (select conv_id, d, seq[1:d] as pre, seq[1:d - 1] as up, d = size as ends, seq[d].text as last from p),
n as (select d, pre, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs,
      case when d = 0 then 0 else (count(*) - 1) * length(any_value(last)) end as saved,
      sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
      from m group by d, pre),
k as (select up as pre, count(*) as n_children from n where d > 0 group by up),
w as (select n.*, coalesce(k.n_children, 0) as n_children from n left join k on k.pre = n.pre),
a as (select unnest(range(0, d + 1)) as z, pre, saved, n_children from w),
u as (select pre[1:z] as pre, sum(saved) as saved_tokens, count(*) filter (n_children = 0) as n_leaves from a group by 1)
select w.conv_id, w.d as depth, case when w.d > 0 then f.conv_id end as parent_conv_id, w.n_convs, w.n_children,
       u.n_leaves, u.saved_tokens::bigint as saved_tokens, w.ends_sha256
from w join u on u.pre = w.pre left join w f on f.pre = w.up and w.d > 0
"""


@query("op13_prefixtrie", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
