"""One query per operator, over its whole table. They derive the columns of the results from
what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import (
    bpe_lexicon,
    cuckoo,
    mixing,
    near_dedup,
    neighbours,
    periodic_runs,
    pii,
    prefix_trie,
    suffix_arrays,
    token_files,
    toxicity,
    url_rules,
    warc_audit,
)
from matchlake.llm.labelled import held_out
from matchlake.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

END_ID = 2


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query
def op1_association_rules(spark, sf_dir):
    """Verdict on the url of every page, by written rules and by rules mined from what those decide."""
    judged = url_rules.judged(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined", "confidence")


@query
def op2_token_files(spark, sf_dir):
    """Token ids of every document, read back from the files they were written to."""
    path = shared_folder(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file(), END_ID)
    return token_files.token_digests(spark, path)


@query
def op3_weak_supervision_pii(spark, sf_dir):
    """Personal data in every document: base spans, and those that the trained classifier adds."""
    found = pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query
def op4_source_mixing(spark, sf_dir):
    """How many words of every document the mix of all sources takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    mixed = mixing.copies(docs, size=F.col("size"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE["op4_source_mixing"] = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents
), sources as (
  select source, sum(size)::bigint as source_size, 3 * sum(size)::bigint as cap from sized group by source
), weighted as (
  select *, [5.0::double, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight from sources
), ordered as (
  select *, cap / weight as ratio from weighted
), filled as (
  select *, (select sum(source_size) from sources) - coalesce(sum(cap) over below, 0) as left_over, sum(weight) over from_here as open
  from ordered
  window below as (order by ratio, source rows between unbounded preceding and 1 preceding),
         from_here as (order by ratio, source rows between current row and unbounded following)
), level as (
  select left_over::double / open as share from filled where left_over::double / open <= ratio order by ratio, source limit 1
), targets as (
  select source, source_size, least(weight * (select share from level), cap::double) as target from weighted
), placed as (
  select *, row_number() over (partition by source order by size desc, doc_id nulls last) - 1 as k from sized
), stairs as (
  select p.doc_id, p.size, t.source_size, t.target, p.k,
    case when t.source_size > 0 then floor(t.target / t.source_size * 16777216)::bigint else 0 end as rate,
    ('0x' || substr(md5('0:' || coalesce(p.source, '')), 1, 6))::bigint as start
  from placed p join targets t on p.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  size * ((((k + 1) * rate + start) >> 24) - ((k * rate + start) >> 24)) as taken
from stairs
"""


@query
def op5_suffix_arrays(spark, sf_dir):
    """Words of every document inside windows of benchmark items, and the items they belong to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_arrays.matches(docs, table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    items = F.array_sort(F.array_distinct(F.transform("item_matches", lambda m: F.coalesce(m["item_id"].cast("string"), F.lit("")))))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


@query
def op6_minhash_bayes(spark, sf_dir):
    """Groups of documents linked by three-word shingles with a similarity of 0.85 or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_dedup.near_duplicates(docs, near_dedup.Similarity(words=3, percent=85))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@query
def op7_cuckoo_dedup(spark, sf_dir):
    """The document that stays of each group of equal texts."""
    found = cuckoo.duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op7_cuckoo_dedup"] = r"""
with hashed as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
), groups as (
  select text_sha256, min(doc_id) as keep_id, count(*) as group_size from hashed group by text_sha256
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from hashed join groups using (text_sha256)
"""


def _predictions(scored: DataFrame, score: str, least: float) -> DataFrame:
    predicted = F.when(F.col(score) >= least, 1).otherwise(0)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(score).alias("score"), predicted.alias("predicted"))


@query
def op8_toxic_sentences(spark, sf_dir):
    """Toxicity of every document, learned from labels of whole documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return _predictions(toxicity.score(docs, model), "toxicity", 0.5)


@query
def op10_quality_neighbours(spark, sf_dir):
    """Quality of every document by its nearest labelled neighbours."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = neighbours.fit(docs, table(spark, sf_dir, "labels"))
    return _predictions(neighbours.score(docs, model), "quality", 0.3)


#: A page of which the second replica has another first byte: an arbitrary 256th of them.
DAMAGED = "substr(md5(url), 1, 2) = '00' AND substr(html, 1, 1) = '<'"


@query
def op9_merkle_audit(spark, sf_dir):
    """All pages as WARC records, audited against a second replica with some damaged bytes."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    damaged = pages.withColumn("html", F.expr(f"CASE WHEN {DAMAGED} THEN '~' || substr(html, 2) ELSE html END"))
    replicas = [shared_folder(spark, f"warc-{n}") for n in (1, 2)]
    for replica, path in zip((pages, damaged), replicas, strict=True):
        warc_audit.write_warc(replica, path)
    found = warc_audit.audit(spark, *replicas)
    page_id = F.regexp_extract("record_id", r"<urn:page:(-?\d*)>", 1).try_cast("long")
    return found.select(page_id.alias("page_id"), "length", "sha256", "status")


ORACLE["op9_merkle_audit"] = """
with records as (
  select page_id, url, html, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::varchar, '') || '>'
    || chr(13) || chr(10) || 'WARC-Target-URI: '
    || replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
    || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) as record
  from pages
)
select page_id, strlen(record)::bigint as length, sha256(record) as sha256,
  case when substr(md5(url), 1, 2) = '00' and substr(html, 1, 1) = '<' then 'differs' else 'intact' end as status
from records
"""


@query
def op13_periodic_runs(spark, sf_dir):
    """Runs of repeated words in every document, some of which get a periodic tail first."""
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs.periodic_runs(docs.select("doc_id", periodic_runs.planted(F.col("doc_id"), F.col("text")).alias("text")))
    none = F.lit(None).cast(found.schema["runs"].dataType.elementType)
    better = lambda a, r: a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"])
    best = F.aggregate("runs", none, lambda a, r: F.when(better(a, r), r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}") for name in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: The unsigned crc32 of a text, bit by bit.
CRC32 = """xor(4294967295::ubigint, list_reduce(
    list_prepend(4294967295::ubigint, list_transform(range(1, strlen({0}) + 1), lambda i: ascii(substr({0}, i, 1))::ubigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::ubigint, 0, 0, 0, 0, 0, 0, 0]), lambda d, z: xor(d >> 1, 3988292384::ubigint * (d & 1)))))"""

#: Every pair of equal words of a document is a place of a diagonal; diagonals are islands of places.
ORACLE["op13_periodic_runs"] = f"""
with hashed as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words, {CRC32.format("doc_id::varchar")}::bigint as h from documents
), sized as (
  select *, len(words) as n, h // 10 as g from hashed
), tailed as (
  select *, case when h % 10 = 0 and n > 0 then g % n else n end as a from sized
), placed as (
  select *, 1 + (n - a) // (3 + g % 8) as p from tailed
), word as (
  select doc_id, n, i, words[1 + case when i < a then i else a + (i - a) % p end] as word from placed, unnest(range(n)) as x(i)
), pair as (
  select v.doc_id, v.n, v.i, v.i - u.i as period from word v join word u on u.doc_id = v.doc_id and u.word = v.word and u.i < v.i
  where 3 * (v.i - u.i) <= v.n
), diagonal as (
  select doc_id, period, min(i) - period as start, count(*) + period as length
  from (select *, i - row_number() over (partition by doc_id, period order by i) as island from pair)
  group by doc_id, period, island having count(*) + period >= greatest(24, 3 * period)
), run as (
  select * from diagonal d where not exists (
    select 1 from diagonal s where s.doc_id = d.doc_id and s.period < d.period and s.start <= d.start and s.start + s.length >= d.start + d.length)
), best as (
  select *, row_number() over (partition by doc_id order by length / period desc, start, period) as place from run
), report as (
  select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines from run group by doc_id
), dropped as (
  select distinct doc_id, unnest(range(start + period, start + length)) as i from run
), collapsed as (
  select doc_id, string_agg(word, ' ' order by i) as text from word anti join dropped using (doc_id, i) group by doc_id
)
select doc_id, coalesce(n_runs, 0) as n_runs, start, length, period, 1000 * length // period as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(c.text, '')) as collapsed_sha256
from documents left join report using (doc_id) left join (from best where place = 1) using (doc_id) left join collapsed c using (doc_id)
"""


@query
def op12_prefix_trie(spark, sf_dir):
    """Every distinct prefix of the spliced conversations, with what sharing it saves."""
    lists = prefix_trie.turn_lists(table(spark, sf_dir, "conversations"))
    nodes = prefix_trie.prefix_nodes(prefix_trie.spliced(lists))
    return nodes.withColumnRenamed("saved_chars", "saved_tokens")


ORACLE["op12_prefix_trie"] = f"""
with turn as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first) as k, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
), conv as (
  select conv_id, conv_id - conv_id % 100 as head, {CRC32.format("conv_id::varchar")} % 6 as h from (select distinct conv_id from turn)
), rebuilt as (
  select c.conv_id, k, role, text from conv c join turn t on t.conv_id = c.head and k <= h
  union all
  select c.conv_id, k, role, text from conv c join turn t on t.conv_id = c.conv_id and k > h
), prefix as (
  select conv_id, row_number() over follow as depth, length(text) as chars,
    string_agg(md5(length(role) || ':' || role || text), '') over follow as node
  from rebuilt window follow as (partition by conv_id order by k)
  union all
  select conv_id, 0, 0, '' from conv
), node as (
  select node, min(conv_id) as conv_id, any_value(depth) as depth, any_value(chars) as chars, count(*) as n_convs,
    substr(node, 1, greatest(length(node) - 32, 0)) as parent
  from prefix group by node
), last as (
  select conv_id, arg_max(node, depth) as node from prefix group by conv_id
), ended as (
  select node, string_agg(conv_id::varchar, ',' order by conv_id) as ids from last group by node
), child as (
  select parent as node, count(*) as n_children from node where depth > 0 group by parent
), below as (
  select p.node, sum((n.n_convs - 1) * n.chars)::bigint as saved_tokens, count(*) filter (where c.node is null) as n_leaves
  from node n join prefix p on p.conv_id = n.conv_id and p.depth <= n.depth left join child c on c.node = n.node group by p.node
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens,
  sha256(coalesce(ids, '')) as ends_sha256
from node n left join node p on p.node = n.parent and n.depth > 0 left join child c on c.node = n.node
  left join ended e on e.node = n.node join below b on b.node = n.node
"""


@query
def op11_bpe_lexicon(spark, sf_dir):
    """Every document's ids by a lexicon of common words and by merging the others, and their text again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokenizer = word_tokenizer_file()
    encoded = bpe_lexicon.encode(docs, tokenizer, bpe_lexicon.lexicon(docs, tokenizer))
    return bpe_lexicon.decode(encoded, tokenizer).select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
