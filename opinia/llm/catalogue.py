"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinia.llm import (
    ann,
    merkle,
    mixing,
    packing,
    quality,
    sharding,
    simhash,
    suffix_lm,
    topk,
    toxicity,
    trie,
    urlfilter,
    warc,
)
from opinia.llm.common import Scratch, bucket, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def pieces_of(docs: DataFrame, capacity: int = 2048) -> DataFrame:
    """Token pieces by the public vocabulary of 50,257 byte-level tokens.

    ``byte_bpe_50k.tiktoken`` has the ranks of ``byte_bpe_50k.json``; the ids are the same.
    """
    import public_tokenizers as public

    special = {"<|endoftext|>": 50256}
    ranks, vocabulary = public.path("byte_bpe_50k.tiktoken"), public.path("byte_bpe_50k.json")
    return packing.token_pieces(docs, ranks, public.PATTERN, special, vocabulary, capacity)


@query
def op1_simhash(spark, sf):
    """Fingerprints of three-word shingles, linked at three bits or fewer."""
    return simhash.near_duplicates(table(spark, sf, "documents"), shingle=3, distance=3)


@query
def op2_packing(spark, sf):
    """Pieces of at most 2,048 tokens in as few sequences as the method finds."""
    pieces = pieces_of(table(spark, sf, "documents"), 2048)
    digest = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digest, 2048)


@query
def op9_mixing(spark, sf):
    """Whole copies and Pareto order samples of every source, to weights 1, 2, 3, repeating."""
    found = mixing.mix(table(spark, sf, "documents"), cycle=(1, 2, 3), most=3, seed=7)
    return found.select("doc_id", "size", "source_size", "target", "taken")


MIXING_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
shares(k, source, source_size, weight, cap, capped, again) AS (
  SELECT 0, source, source_size, weight, 3 * source_size, false, true
  FROM (SELECT source, sum(size)::BIGINT AS source_size,
          (1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3)::BIGINT AS weight
        FROM d GROUP BY source)
  UNION ALL
  SELECT k + 1, source, source_size, weight, cap, capped OR share > cap, bool_or(share > cap AND NOT capped) OVER ()
  FROM (SELECT *, weight * (n - taken)::DOUBLE / greatest(1, w - used)::DOUBLE AS share
    FROM (SELECT *, sum(source_size) OVER () AS n, sum(weight) OVER () AS w,
        sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS taken,
        sum(CASE WHEN capped THEN weight ELSE 0 END) OVER () AS used FROM shares WHERE again))),
targets AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE weight * (n - taken)::DOUBLE / greatest(1, w - used)::DOUBLE END AS target
  FROM (SELECT *, sum(source_size) OVER () AS n, sum(weight) OVER () AS w,
      sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS taken,
      sum(CASE WHEN capped THEN weight ELSE 0 END) OVER () AS used
    FROM shares WHERE NOT again)),
k AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, least(CASE WHEN source_size > 0 THEN target / source_size - whole ELSE 0 END, 1 - 1e-9) AS p,
    target - whole * source_size AS owed,
    (('0x' || substr(md5('7:' || doc_id), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM k),
open_(doc_id, source, size, rank, owed, fits) AS (
  SELECT doc_id, source, size, rank, owed,
    sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id, size ROWS UNBOUNDED PRECEDING) <= owed
  FROM (SELECT *, (u / (1 - u)) / (p / (1 - p)) AS rank FROM p WHERE p > 0 AND size > 0 AND size <= owed)
  UNION ALL
  SELECT doc_id, source, size, rank, owed,
    sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id, size ROWS UNBOUNDED PRECEDING) <= owed
  FROM (SELECT doc_id, source, size, rank, fits, owed - sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY source) AS owed FROM open_)
  WHERE NOT fits AND size <= owed),
x AS (SELECT doc_id FROM open_ WHERE fits)
SELECT p.doc_id, p.size, p.source_size, p.target, (p.size * (p.whole + CASE WHEN x.doc_id IS NULL THEN 0 ELSE 1 END))::BIGINT AS taken
FROM p LEFT JOIN x ON p.doc_id = x.doc_id
"""


SQL["op9_mixing"] = MIXING_SQL


@query
def op7_quality(spark, sf):
    """The label model's verdict on every document."""
    found = quality.judge(table(spark, sf, "documents"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *base, "base_failed", "kept", "posterior")


@query
def op5_toxicity(spark, sf):
    """The machine's score of every document; learnt from labels that are not held out."""
    found = toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"), sample=6000, threshold=0.3)
    return found.select("doc_id", (bucket("doc_id", 4) == 2).alias("held_out"), "score", "predicted", "worst_sentence")


@query
def op8_suffix_lm(spark, sf):
    """Base score and suffix-tree score of every document; a tenth is not learnt from."""
    return suffix_lm.score(table(spark, sf, "documents"), held_out=10, least=2, frequent=4e-6)


@query
def op6_sharding(spark, sf):
    """From six old shards, in which sources are together, to eight of equal bytes."""
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(6))
    found = sharding.reshard(table(spark, sf, "documents"), old, [1] * 8)
    return found.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op4_warc(spark, sf):
    """Pages written as archives and read back by the chain of their records."""
    scratch = Scratch(spark, "warc")
    folder = scratch.path("archives")
    warc.write_warc(table(spark, sf, "pages"), folder, scratch, least=1000)
    records = warc.read_warc(spark, folder, scratch)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1).try_cast("long")
    return records.select(
        page("record_id").alias("page_id"),
        "payload_length",
        F.coalesce(F.sha1("payload"), F.regexp_extract("digest", "^sha1:(.*)$", 1)).alias("payload_digest"),
        F.col("type").alias("record_type"),
        page("refers_to").alias("refers_to"),
    ).withColumnRenamed("payload_length", "payload_bytes")


SQL["op4_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
d AS (SELECT *, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM d
"""


@query
def op10_prefix_forest(spark, sf):
    """The ten nearest found of every hundredth vector."""
    return ann.search(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10, trees=10, recall=0.95)


#: 2024-01-01 in seconds; captures and list changes fall into the 400 days from then on.
DAY, START = 86_400, 1_704_067_200


def drawn(text):
    """A number that the text decides."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def captures_and_changes(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Captures: the pages, each with a time of its id. List changes: of every page, one of a
    list that its host tells, at a time that its URL tells: in turns its domain, its host and
    its URL's first two segments are listed or, by every third page, taken off."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.lit(START) + F.pmod(F.col("page_id") * 7919, F.lit(400 * DAY)))
    host = urlfilter.host_of(F.col("url"))
    start = F.array_join(F.slice(urlfilter.segments_of(F.col("url")), 1, 2), "/")
    turn = F.pmod("page_id", F.lit(20))
    key = (
        F.when(turn == 0, F.concat(F.lit("d:"), host))
        .when(turn == 1, F.concat(F.lit("d:"), F.array_join(F.slice(F.split(host, r"\."), -3, 3), ".")))
        .otherwise(F.concat(F.lit("u:"), host, F.lit("/"), start))
    )
    changes = pages.select(
        F.element_at(F.array(*map(F.lit, ("gambling", "malware", "spam"))), (drawn(host) % 3 + 1).cast("int")).alias("list"),
        key.alias("key"),
        (F.lit(START) + drawn(F.col("url")) % (400 * DAY)).alias("changed_at"),
        (F.pmod("page_id", F.lit(3)) != 0).alias("listed"),
    )
    return captures, changes


@query
def op3_url_filter(spark, sf):
    """Every page against the entries that were active when it was fetched."""
    captures, changes = captures_and_changes(spark, sf)
    found = urlfilter.filter_urls(captures, changes)
    return found.select("page_id", "host", "fetched_at", "blocked", "n_active", "entry", "lists")


SQL["op3_url_filter"] = r"""
WITH p AS (
  SELECT page_id, url, 1704067200 + (page_id * 7919) % 34560000 AS fetched_at,
    nullif(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '\.$', ''), '') AS host,
    regexp_extract_all(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1), '[^/]+') AS segments
  FROM pages),
c AS (
  SELECT ['gambling', 'malware', 'spam'][('0x' || substr(md5(host), 1, 8))::BIGINT % 3 + 1] AS list,
    CASE page_id % 20 WHEN 0 THEN 'd:' || host WHEN 1 THEN 'd:' || array_to_string(string_split(host, '.')[-3:], '.')
      ELSE 'u:' || host || '/' || array_to_string(segments[1:2], '/') END AS key,
    1704067200 + ('0x' || substr(md5(url), 1, 8))::BIGINT % 34560000 AS changed_at, page_id % 3 <> 0 AS listed
  FROM p),
o AS (SELECT list, key, changed_at, min(listed) AS listed FROM c WHERE list IS NOT NULL AND key IS NOT NULL GROUP BY ALL),
i AS (SELECT *, lead(changed_at) OVER (PARTITION BY list, key ORDER BY changed_at) AS until FROM o),
k AS (
  SELECT page_id, fetched_at, 'd:' || array_to_string(string_split(host, '.')[j:], '.') AS key
  FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS j FROM p WHERE host IS NOT NULL)
  UNION ALL
  SELECT page_id, fetched_at, 'u:' || host || '/' || array_to_string(segments[1:j], '/')
  FROM (SELECT *, unnest(range(1, least(len(segments), 2) + 1)) AS j FROM p WHERE host IS NOT NULL)),
a AS (
  SELECT page_id, count(*) AS n_active, first(k.key ORDER BY -length(k.key), k.key) AS entry,
    array_to_string(list_sort(list(DISTINCT list)), ',') AS lists
  FROM k JOIN i ON k.key = i.key AND i.listed AND i.changed_at <= fetched_at AND (until IS NULL OR fetched_at < until)
  GROUP BY page_id)
SELECT page_id, host, fetched_at, n_active IS NOT NULL AS blocked, coalesce(n_active, 0)::BIGINT AS n_active, entry, lists
FROM p LEFT JOIN a USING (page_id)
"""


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII text, bit by bit."""
    bit = "xor(h >> 1, (h & 1) * 3988292384::UBIGINT)"
    step = f"list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]), lambda h, i: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ord(x)::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda c, b: {step}), 4294967295::UBIGINT)"


@query
def op11_prefix_trie(spark, sf):
    """The nodes of the trie of rebuilt conversations."""
    return trie.nodes(trie.rebuilt(table(spark, sf, "conversations"), group=100, spread=6))


SQL["op11_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k,
    {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, {crc32_sql("conv_id::VARCHAR")} % 6 AS h FROM t),
r AS (
  SELECT c.conv_id, 0 AS part, k, turn FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND k <= h
  UNION ALL SELECT c.conv_id, 1, k, turn FROM c JOIN t ON t.conv_id = c.conv_id AND k > h),
w AS (
  SELECT c.conv_id, coalesce(path, []) AS path
  FROM c LEFT JOIN (SELECT conv_id, list(turn ORDER BY part, k) AS path FROM r GROUP BY conv_id) USING (conv_id)),
m AS (SELECT conv_id, len(path) AS size, unnest(range(0, len(path) + 1)) AS depth, path FROM w),
g AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM m GROUP BY ALL),
k AS (SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY ALL),
f AS (
  SELECT g.*, coalesce(n_children, 0) AS n_children, k.node IS NULL AS leaf,
    CASE WHEN g.depth = 0 THEN 0 ELSE (n_convs - 1) * length(g.node[g.depth].text) END AS saved
  FROM g LEFT JOIN k ON g.node = k.node AND g.depth = k.depth),
s AS (
  SELECT node[1:j] AS node, j AS depth, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS j FROM f) GROUP BY ALL)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM f JOIN s ON f.node = s.node AND f.depth = s.depth
LEFT JOIN f p ON f.depth > 0 AND p.node = f.node[1:f.depth - 1] AND p.depth = f.depth - 1
"""


@query
def op12_merkle(spark, sf):
    """Every document's leaf, roots and proof, and what the proof gives for what is found."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = merkle.manifest(table(spark, sf, "documents"), columns, "doc_id", "lang", found)
    rows = rows.withColumn("folded_root", merkle.folded(F.col("found_leaf"), F.col("path")))
    return rows.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _merkle_sql() -> str:
    """The levels of a tree as lists; a leaf walks up along its siblings."""
    shown = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(({c})::VARCHAR) || ':' || ({c})::VARCHAR END"
    leaf = lambda n: f"sha256({' || '.join(map(shown, ('doc_id', 'source', 'lang', n, 'text')))})"
    tampered = f"n_chars + CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 7 = 0 THEN 1 ELSE 0 END"
    parents = "list_transform(range(1, len(h) + 1, 2), lambda i: sha256(h[i] || coalesce(h[i + 1], '')))"
    sibling = "coalesce(h[xor(slot, 1) + 1], '')"
    step = f"""slot // 2, CASE WHEN slot % 2 = 0 THEN sha256(f || {sibling}) ELSE sha256({sibling} || f) END,
    proof || {sibling}"""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {leaf("n_chars")} AS leaf, {leaf(tampered)} AS found FROM documents),
s AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot FROM d),
up(l, lang, h) AS (
  SELECT 0, lang, list(leaf ORDER BY slot) FROM s GROUP BY lang
  UNION ALL SELECT l + 1, lang, {parents} FROM up WHERE len(h) > 1),
tops AS (SELECT lang, h[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS slot FROM up WHERE len(h) = 1),
high(l, h) AS (SELECT 0, list(subroot ORDER BY slot) FROM tops UNION ALL SELECT l + 1, {parents} FROM high WHERE len(h) > 1),
way(doc_id, leaf, lang, l, slot, f, proof) AS (
  SELECT doc_id, leaf, lang, 0, slot, found, '' FROM s
  UNION ALL SELECT doc_id, leaf, w.lang, w.l + 1, {step}
  FROM way w JOIN up ON w.lang IS NOT DISTINCT FROM up.lang AND w.l = up.l WHERE len(h) > 1),
a AS (
  SELECT doc_id, leaf, subroot, tops.slot, f, proof
  FROM way w JOIN up ON w.lang IS NOT DISTINCT FROM up.lang AND w.l = up.l AND len(h) = 1
  JOIN tops ON w.lang IS NOT DISTINCT FROM tops.lang),
way2(doc_id, leaf, subroot, l, slot, f, proof) AS (
  SELECT doc_id, leaf, subroot, 0, slot, f, proof FROM a
  UNION ALL SELECT doc_id, leaf, subroot, w.l + 1, {step} FROM way2 w JOIN high ON w.l = high.l WHERE len(h) > 1)
SELECT doc_id, leaf, subroot, h[1] AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h[1] AS verified
FROM way2 w JOIN high ON w.l = high.l WHERE len(h) = 1
"""


SQL["op12_merkle"] = _merkle_sql()


@query
def op13_topk(spark, sf):
    """The twenty highest integer inner products of every twentieth vector."""
    return topk.search(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


SQL["op13_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score,
  row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id)::INTEGER AS rank
FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
QUALIFY rank <= 20
"""
