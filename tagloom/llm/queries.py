"""The package's queries over the test tables, and SQL that checks some of them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.conversation_trie import Borrowing, prefix_trie
from tagloom.llm.decontamination import contaminated
from tagloom.llm.language_id import identify, learn_profiles
from tagloom.llm.lexical_search import ranked_documents
from tagloom.llm.mixing import mixed
from tagloom.llm.nearest import nearest
from tagloom.llm.ngram_join import similar_documents
from tagloom.llm.quality import quality
from tagloom.llm.scratch import Scratch, crc_of_id, let_workers_import, read
from tagloom.llm.sharding import write_shards
from tagloom.llm.substring_dedup import removed_passages
from tagloom.llm.token_counts import load_vocabulary, token_counts
from tagloom.llm.toxicity import scored, train
from tagloom.llm.url_filter import Rule, judged_urls

Query = Callable[[SparkSession, str], DataFrame]


def _language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    held_out = crc_of_id() % 5 == 0
    languages, profiles = learn_profiles(docs.where(~held_out))
    found = identify(docs, languages, profiles, keep={"held_out": held_out})
    return found.select("doc_id", "held_out", "lang_pred", "score")


URL_RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]


def _url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return judged_urls(read(spark, sf, "pages"), URL_RULES)


def _ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return similar_documents(read(spark, sf, "documents"))


def passage_digest(found: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), "kept_sha256")


def _substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return passage_digest(removed_passages(read(spark, sf, "documents")))


def shard_digest(shards: DataFrame) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return shards.select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _sharding(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{Scratch(spark).root}/shards"
    return shard_digest(write_shards(read(spark, sf, "documents"), path))


def _toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, held_out = read(spark, sf, "documents"), crc_of_id() % 4 == 2
    network, thresholds = train(docs, read(spark, sf, "labels").where(~held_out))
    found = scored(docs, network, thresholds, keep={"held_out": held_out})
    return found.select("doc_id", "held_out", "score", "predicted", "threshold", "flagged")


def _mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixed(read(spark, sf, "documents"))


def _decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def _nearest(spark: SparkSession, sf: str) -> DataFrame:
    vectors = read(spark, sf, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def trusted_ids(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "labels").where("quality = 1").select("doc_id")


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality(read(spark, sf, "documents"), trusted_ids(spark, sf))


def _prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(read(spark, sf, "conversations"), Borrowing(family=5, spread=9))


def _token_counts(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = load_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return token_counts(read(spark, sf, "documents"), vocabulary, limit=1024)


def _lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_documents(read(spark, sf, "documents"), read(spark, sf, "benchmark"), k=20)


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        let_workers_import(spark)
        return query(spark, sf)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_language_id": _language_id,
        "op2_url_filter": _url_filter,
        "op3_ngram_join": _ngram_join,
        "op4_substring_dedup": _substring_dedup,
        "op5_sharding": _sharding,
        "op6_toxicity": _toxicity,
        "op7_mixing": _mixing,
        "op8_decontamination": _decontamination,
        "op9_nearest": _nearest,
        "op10_quality": _quality,
        "op11_prefix_trie": _prefix_trie,
        "op12_token_counts": _token_counts,
        "op13_lexical_search": _lexical_search,
    }
    return {name: _ready(query) for name, query in found.items()}


_WORDS_SQL = r"list_filter(string_split_regex(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

_SUBSTRING_SQL = f"""
with texts as (
  select row_number() over () as n, doc_id, {_WORDS_SQL.format("text")} as words from documents),
placed as (
  select n, words, unnest(range(1, len(words) - 33)) as first from texts where len(words) >= 35),
windows as (select n, first, array_to_string(words[first:first + 34], ' ') as passage from placed),
again as (select n, first from windows qualify count(*) over (partition by passage) > 1),
covered as (select distinct n, unnest(range(first, first + 35)) as place from again),
each_word as (
  select n, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from texts),
kept as (
  select n, string_agg(word, ' ' order by place) as joined
  from each_word e where not exists (select 1 from covered c where c.n = e.n and c.place = e.place)
  group by n),
gone as (select n, count(*) as removed from covered group by n)
select t.doc_id, len(t.words) as n_words, coalesce(g.removed, 0) as n_removed,
  sha256(coalesce(k.joined, '')) as kept_sha256
from texts t left join kept k on k.n = t.n left join gone g on g.n = t.n"""


_NGRAM_SQL = f"""
with recursive texts as (
  select doc_id, {_WORDS_SQL.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as words
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 5
    then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as shingle
  from texts),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * shared >= 80 * (x.n + y.n - shared)),
reached as (
  select doc_id, doc_id as other from texts
  union
  select r.doc_id, l.b from reached r join links l on l.a = r.other)
select t.doc_id, coalesce(s.n, 0) as n_shingles, min(r.other) as component_id
from texts t join reached r on r.doc_id = t.doc_id left join sizes s on s.doc_id = t.doc_id
group by t.doc_id, s.n"""


# Fixed value: the polynomial of crc32, whose bits are taken one by one.
_CRC32 = """
  select conv_id, decimal, 0 as bit, 4294967295::bigint as state
  from (select distinct conv_id, conv_id::varchar as decimal from conversations where conv_id is not null)
  union all
  select conv_id, decimal, bit + 1, case when mixed & 1 = 1 then xor(mixed >> 1, 3988292384) else mixed >> 1 end
  from (select *, case when bit % 8 = 0 then xor(state, ascii(substr(decimal, (bit // 8 + 1)::int, 1))::bigint)
      else state end as mixed
    from crc where bit < 8 * length(decimal))"""

_TRIE_SQL = f"""
with recursive crc as ({_CRC32}),
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, md5(
      concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) - 1 as place
  from conversations where conv_id is not null),
lengths as (select conv_id, count(*) as n from turns group by conv_id),
convs as (
  select c.conv_id, c.conv_id - c.conv_id % 5 as base, xor(state, 4294967295) % 9 as h,
    least(xor(state, 4294967295) % 9, coalesce(b.n, 0)) as borrowed
  from crc c left join lengths b on b.conv_id = c.conv_id - c.conv_id % 5
  where bit = 8 * length(decimal)),
rebuilt as (
  select c.conv_id, t.place, t.role, t.text
  from convs c join turns t on t.conv_id = c.base and t.place < c.h
  union all
  select c.conv_id, t.place - c.h + c.borrowed, t.role, t.text
  from convs c join turns t on t.conv_id = c.conv_id and t.place >= c.h),
paths as (
  select conv_id, text, list([role, text]) over (
    partition by conv_id order by place rows between unbounded preceding and current row) as path
  from rebuilt),
members as (
  select conv_id, path, strlen(text) as size from paths
  union all
  select conv_id, []::varchar[][], 0 from convs),
ends as (
  select path, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from (select conv_id, path from members qualify row_number() over (partition by conv_id order by len(path) desc) = 1)
  group by path),
nodes as (
  select path, len(path) as depth, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(size) as saved
  from members group by path),
children as (select path[:-2] as path, count(*) as n from nodes where depth > 0 group by 1),
above as (select path, unnest(range(0, depth + 1)) as d, saved from nodes),
subtrees as (
  select a.path[:a.d] as path, sum(a.saved)::bigint as saved_tokens, count(*) filter (c.n is null) as n_leaves
  from above a left join children c on c.path = a.path group by 1)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children, s.n_leaves,
  s.saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from nodes n join subtrees s on s.path = n.path left join children c on c.path = n.path
  left join nodes p on n.depth > 0 and p.path = n.path[:-2] left join ends e on e.path = n.path"""


_TERMS_SQL = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

_SEARCH_SQL = f"""
with texts as (select row_number() over () as row, doc_id, {_TERMS_SQL} as terms from documents),
wanted as (
  select item_id, term, count(*) as times
  from (select item_id, unnest({_TERMS_SQL}) as term from benchmark) group by all),
totals as (select count(*) filter (len(terms) > 0) as documents, sum(len(terms))::bigint as total from texts),
each_term as (select row, doc_id, len(terms) as n, unnest(terms) as term from texts),
often as (
  select row, doc_id, n, term, count(*) as tf
  from each_term where term in (select term from wanted) group by all),
holding as (select term, count(*) as df from often group by term),
weights as (
  select term, floor(1000 * ln((2 * documents + 2)::double / (2 * df + 1)::double))::bigint as w from holding, totals),
parts as (
  select row, doc_id, term,
    w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * documents) // total))) as part
  from often join weights using (term), totals),
scores as (
  select item_id, row, doc_id, sum(times * part)::bigint as score from wanted join parts using (term) group by all),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scores where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_ngram_join": _NGRAM_SQL,
        "op4_substring_dedup": _SUBSTRING_SQL,
        "op11_prefix_trie": _TRIE_SQL,
        "op13_lexical_search": _SEARCH_SQL,
    }
