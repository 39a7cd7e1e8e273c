"""The registered query of each operator, over its whole table, and its DuckDB twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtables.llm import chat, decontaminate, embedding_dup, html_text, language_id, line_dedup, near_dup, pieces, prefix_trie, quality, repeats, toxicity, whitening
from flowtables.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its own name, with its DuckDB twin if there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query("""
with doc as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
lines as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as pos from doc),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
shared as (select k, min(doc_id) as first_doc from keyed where length(k) >= 10 group by k having count(distinct doc_id) >= 2),
marked as (select keyed.*, first_doc is not null and doc_id != first_doc as gone from keyed left join shared using (k))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id
""")
def op8_line_dedup(spark, sf_dir):
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query()
def op2_minhash_near_dedup(spark, sf_dir):
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), words=3, percent=85)


@query()
def op5_decontamination(spark, sf_dir):
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query()
def op9_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    net = language_id.fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    return language_id.predict(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op1_importance_resampling(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    good = read_table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality.resample(docs, quality.fit(docs, good))


@query()
def op7_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = read_table(spark, sf_dir, "labels")
    machine = toxicity.fit(docs, labels.where(~held_out))
    scored = toxicity.score(docs, machine, columns=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("""
with said as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(case role when 'system' then 8 + 9 when 'user' then 7 + 8 else 4 + 5 end + length(text)
         + case when conv_id = -1 then 3 else 0 end) as bigint) as formatted_chars
from said group by conv_id
""")
def op10_chat_format(spark, sf_dir):
    said = read_table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], said.schema)
    return chat.digests(chat.format_chats(said.union(probe)))


@query()
def op3_embedding_near_dedup(spark, sf_dir):
    return embedding_dup.near_vectors(read_table(spark, sf_dir, "embeddings"))


@query()
def op4_html_extraction(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages))


@query()
def op6_sentencepiece(spark, sf_dir):
    encoded = pieces.encode(read_table(spark, sf_dir, "documents"), columns=["doc_id"])
    decoded = pieces.decode(encoded)
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.length("text").cast("long").alias("decoded_chars"), F.sha2("text", 256).alias("decoded_sha256"))


@query()
def op11_embedding_whitening(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return whitening.transform(vectors, whitening.fit(vectors))


# conversation c begins with the first crc32(c) % 4 turns of conversation c - c % 20; the checksum is worked out bit by bit, as DuckDB has none
@query("""
with ids as (select distinct conv_id as c, list_transform(range(1, length(cast(conv_id as varchar)) + 1), lambda i: ascii(substr(cast(conv_id as varchar), i, 1))::ubigint) as bytes from conversations where conv_id is not null),
crc as (select c, xor(list_reduce(list_prepend(4294967295::ubigint, bytes), lambda acc, b: list_reduce(list_prepend(xor(acc, b), [1::ubigint, 2, 3, 4, 5, 6, 7, 8]), lambda x, i:
  case when x % 2 = 1 then xor(x // 2, 3988292384::ubigint) else x // 2 end)), 4294967295::ubigint) % 4 as h from ids),
own as (select conv_id as c, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns from conversations where conv_id is not null group by conv_id),
conv as (select crc.c, list_concat(coalesce(b.turns[:crc.h], []), o.turns[crc.h + 1:]) as turns from crc join own o using (c) left join own b on b.c = crc.c - crc.c % 20),
path as (select c, d, turns[:d] as node, d = len(turns) as ends, case when d > 0 then len(regexp_extract_all(turns[d].x, '[^\x20\x09-\x0D]+')) else 0 end as words
  from (select c, turns, unnest(range(0, len(turns) + 1)) as d from conv)),
node as (select node, d, min(c) as conv_id, count(*) as n, any_value(words) as words, coalesce(string_agg(cast(c as varchar), ',' order by c) filter (ends), '') as ids from path group by node, d),
child as (select node[:d - 1] as node, count(*) as kids from node where d > 0 group by 1),
full_node as (select node.*, coalesce(kids, 0) as kids from node left join child using (node)),
up as (select unnest(range(0, d + 1)) as a, node, (n - 1) * words as saved, kids = 0 as leaf from full_node),
sub as (select node[:a] as node, sum(saved) as saved, count(*) filter (leaf) as leaves from up group by 1)
select f.conv_id, f.d as depth, p.conv_id as parent_conv_id, f.n as n_convs, f.kids as n_children, sub.leaves as n_leaves, cast(sub.saved as bigint) as saved_tokens, sha256(f.ids) as ends_sha256
from full_node f join sub using (node) left join node p on f.d > 0 and p.node = f.node[:f.d - 1]
""")
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"), donor=lambda c: c - c % 20, take=lambda c: F.crc32(c.cast("string")) % 4)


@query()
def op13_suffix_array_dedup(spark, sf_dir):
    out = repeats.without_repeats(read_table(spark, sf_dir, "documents"), keep_first=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
