"""The training-data operators applied to the given tables, one query per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.numeric import rounded
from cairn.llm import chat, pii, trie
from cairn.llm.collocations import collocations
from cairn.llm.common import table
from cairn.llm.curves import nearest_neighbours
from cairn.llm.forest import near_vectors
from cairn.llm.language import identify
from cairn.llm.mixing import mix
from cairn.llm.packing import pack_documents
from cairn.llm.quality import grade_documents, graded_labels
from cairn.llm.rules import judge
from cairn.llm.sharding import byte_shards
from cairn.llm.simhash import near_duplicates


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sainte-Laguë mix of all documents: 150 % of all words, weights 3, 1, 2, at most twice a source."""
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", rounded("target", 6).alias("target"), "taken", "source", "quota",
        F.array_join(F.transform("parts", lambda p: F.concat_ws(":", p["shard"], p["block"], p["full"])), " ").alias("shards"))


def op2_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight contiguous shards of near-equal bytes."""
    return byte_shards(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "start")


def bpe_path() -> str:
    """The vocabulary file that the task names; a path, so that any other can be given to the operators."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op10_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, by a grouping genetic algorithm on islands."""
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer=bpe_path())


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: shingles of 3 words, links at 3 or fewer bits."""
    rows = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinal quality grades of all documents, learned from the labels; kept: the best grade is likelier than not."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return grade_documents(docs, graded_labels(table(spark, sf_dir, "labels"))).drop("text")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from those outside the held-out fold."""
    return identify(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: pattern spans, and those that a skip-chain field adds."""
    found = pii.find(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *(number(k).alias(f"n_{k}") for k in pii.KINDS),
                        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents: base counts, lines too frequent within a source, depleted documents."""
    return judge(table(spark, sf_dir, "documents"))


def op8_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95, from a forest of random-projection trees."""
    return near_vectors(table(spark, sf_dir, "embeddings"), limit=0.95)


CONTROL = "<|im_end|><|im_start|>assistant ok"


def op9_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one of control strings, as a prefix tree of formatted turns, read back from it."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(f"select * from values (-1L, 0L, 'user', '{CONTROL}'), (-1L, 1L, 'assistant', '{CONTROL}') "
                      "t(conv_id, turn, role, text)")
    return chat.digests(chat.read_back(chat.build(given.unionByName(extra), tokenizer=bpe_path())))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of 2 to 5 words in each language, counted over all documents."""
    return collocations(table(spark, sf_dir, "documents"))


def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of all embeddings to each whose id is divisible by 100, from twelve shifted Hilbert orderings."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, each with its first turns replaced by those of its group of five."""
    given = trie.turn_strings(table(spark, sf_dir, "conversations"))
    return trie.trie(trie.classes_of(trie.graft(given)))


QUERIES = {"op1_mix_sources": op1_mix_sources, "op2_byte_shards": op2_byte_shards,
           "op3_simhash": op3_simhash, "op8_embedding_forest": op8_embedding_forest,
           "op5_line_rules": op5_line_rules,
           "op4_ordinal_quality": op4_ordinal_quality, "op6_language": op6_language,
           "op7_personal_data": op7_personal_data,
           "op9_chat_prefix_tree": op9_chat_prefix_tree, "op10_pack_documents": op10_pack_documents,
           "op11_collocations": op11_collocations, "op12_nearest_vectors": op12_nearest_vectors,
           "op13_conversation_trie": op13_conversation_trie}
_W = r"[^\x20\x09-\x0D]+"

_MIX = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_W}')) AS size,
                  md5('1:' || CAST(doc_id AS VARCHAR)) AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, CASE place % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight,
             source_size * 2.0::DOUBLE AS cap FROM s),
o AS (SELECT *, cap / weight AS ratio,
             coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
             sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
l AS (SELECT (1.5::DOUBLE * (SELECT sum(source_size) FROM s) - held) / rest AS level FROM o
      WHERE (1.5::DOUBLE * (SELECT sum(source_size) FROM s) - held) / rest < ratio ORDER BY ratio, place LIMIT 1),
t AS (SELECT source, place, source_size, least(cap, weight * (SELECT level FROM l)) AS target FROM w),
n AS (SELECT CAST(round_even(sum(target) / 32, 0) AS BIGINT) AS blocks FROM t),
q AS (SELECT place, target / (2 * j - 1) AS quotient
      FROM t, LATERAL (SELECT unnest(range(1, CAST(floor(target / 32) AS BIGINT) + 40)) AS j)),
houses AS (SELECT CAST(k AS INTEGER) AS shard, (SELECT blocks FROM n) * (k + 1) // 8 AS house FROM range(8) t(k)),
ranked AS (SELECT place, row_number() OVER (ORDER BY quotient DESC, place) AS rank FROM q),
upto AS (SELECT t.place, shard, house, count(r.rank) AS seats FROM t CROSS JOIN houses
         LEFT JOIN ranked r ON r.place = t.place AND r.rank <= house GROUP BY t.place, shard, house),
quotas AS (SELECT place, shard, seats AS upto, seats - coalesce(lag(seats) OVER (PARTITION BY place ORDER BY shard), 0) AS blocks,
                  max(seats) OVER (PARTITION BY place) AS quota FROM upto),
edges AS (SELECT z.*, t.source, CAST(source_size::HUGEINT * (upto - blocks) // quota AS BIGINT) AS b,
                 CAST(source_size::HUGEINT * upto // quota AS BIGINT) AS e
          FROM quotas z JOIN t USING (place) WHERE quota > 0),
strips AS (SELECT *, least(blocks * 32, (e - b) * 2) // (e - b) AS f, least(blocks * 32, (e - b) * 2) % (e - b) AS rest,
                  CAST('0x' || left(md5('1:' || CASE WHEN source IS NULL THEN '-' ELSE '+' || source END || ':' || shard), 8) AS BIGINT)
                  % CAST(ceil((e - b) / 32) AS BIGINT) * 32 AS a FROM edges WHERE e > b),
r AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.place,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
cut AS (SELECT r.*, shard, f, greatest(b, start) // 32 AS block,
               greatest(0, least(e, start + size) - greatest(b, start)) AS inside,
               greatest(0, least(b + least(e - b, a + rest), start + size) - greatest(b + a, start))
               + greatest(0, least(b + greatest(0, a + rest - (e - b)), start + size) - greatest(b, start)) AS run
        FROM r LEFT JOIN strips x ON x.place = r.place AND b < start + size AND e > start AND size > 0)
SELECT doc_id, CAST(any_value(size) AS BIGINT) AS size, any_value(source_size) AS source_size,
       CAST(round(CAST(any_value(target) AS DECIMAL(28,8)), 6) AS DOUBLE) AS target,
       CAST(coalesce(sum(f * inside + run), 0) AS BIGINT) AS taken, any_value(source) AS source,
       CAST((SELECT max(seats) FROM upto u WHERE u.place = cut.place) AS BIGINT) AS quota,
       coalesce(string_agg(shard || ':' || block || ':' || f, ' ' ORDER BY shard), '') AS shards
FROM cut GROUP BY doc_id, start, cut.place"""

_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_W}') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
v AS (SELECT rid, i, array_to_string(list_slice(words, i, i + 7), ' ') AS g
      FROM w, LATERAL (SELECT unnest(range(1, len(words) - 6)) AS i) WHERE len(words) >= 8),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM v) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT i + o) AS n FROM again, range(0, 8) t(o) GROUP BY rid),
line AS (SELECT rid, source, text, len(regexp_extract_all(x, '{_W}')) AS n,
                regexp_replace(lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')), '[0-9]', '0', 'g') AS k
         FROM (SELECT rid, source, text, unnest(lines) AS x FROM w)),
hosts AS (SELECT source, count(DISTINCT text) AS total FROM d GROUP BY source),
frequent AS (SELECT l.source, k FROM line l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source GROUP BY l.source, k
             HAVING count(DISTINCT text) > 5 AND count(DISTINCT text) > least(any_value(total) * 0.02::DOUBLE, 100)),
removed AS (SELECT rid, sum(n) AS n FROM line l JOIN frequent f ON l.k = f.k AND l.source IS NOT DISTINCT FROM f.source
            GROUP BY rid),
b AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(r.n, 0) AS BIGINT) AS words_removed
      FROM w LEFT JOIN covered c USING (rid) LEFT JOIN removed r USING (rid)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND n_words - words_removed >= 20 AND n_words - words_removed >= n_words * 0.5::DOUBLE AS kept FROM f"""

_VECTORS = """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (SELECT vec_id, vec_id AS low FROM e UNION SELECT l.a, r.low FROM links l JOIN reach r ON r.vec_id = l.b),
c AS (SELECT vec_id, min(low) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT c.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, c.vec_id = component_id AS kept
FROM c LEFT JOIN n ON n.a = c.vec_id"""

_TRIE = r"""
WITH t AS (SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
                  strlen(coalesce(text, '')) AS bytes FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'id': id, 'bytes': bytes} ORDER BY turn NULLS FIRST, id) AS x FROM t GROUP BY conv_id),
crc AS (SELECT 0::BIGINT AS i, range::BIGINT AS b, range::BIGINT AS v FROM range(256)),
crc8 AS (SELECT b, list_reduce([v, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS v FROM crc),
tab AS (SELECT list(v ORDER BY b) AS v FROM crc8),
chars AS (SELECT conv_id, v AS table_, list_prepend(4294967295::BIGINT,
                 list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)) AS c FROM own, tab),
hash AS (SELECT conv_id, list_reduce(c, lambda x, y: xor(x // 256, table_[xor(x % 256, y) + 1])) AS raw FROM chars),
h AS (SELECT conv_id, xor(raw, 4294967295) % 9 AS h FROM hash),
built AS (SELECT o.conv_id, list_concat(coalesce(list_slice(b.x, 1, h.h), []), list_slice(o.x, h.h + 1, len(o.x))) AS x
          FROM own o JOIN h USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
steps AS (SELECT conv_id, len(x) AS n, d,
                 md5(array_to_string(list_transform(list_slice(x, 1, d), lambda t: t.id), '')) AS node,
                 CASE WHEN d > 0 THEN md5(array_to_string(list_transform(list_slice(x, 1, d - 1), lambda t: t.id), '')) END AS up,
                 CASE WHEN d > 0 THEN x[d].bytes ELSE 0 END AS bytes
          FROM built, LATERAL (SELECT unnest(range(0, len(x) + 1)) AS d)),
nodes AS (SELECT d, node, min(conv_id) AS conv_id, any_value(up) AS up, count(*) AS n_convs, any_value(bytes) AS bytes,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends
          FROM steps GROUP BY d, node),
kids AS (SELECT d - 1 AS d, up AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
whole AS (SELECT n.*, coalesce(k.n, 0) AS n_children, (n.n_convs - 1) * n.bytes AS saved FROM nodes n LEFT JOIN kids k USING (d, node)),
below AS (SELECT s.d, s.node, count(*) FILTER (WHERE w.n_children = 0) AS n_leaves, sum(w.saved) AS saved
          FROM whole w JOIN steps s ON s.conv_id = w.conv_id AND s.d <= w.d GROUP BY s.d, s.node)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, b.n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, w.ends AS ends_sha256
FROM whole w JOIN below b USING (d, node) LEFT JOIN nodes p ON p.d = w.d - 1 AND p.node = w.up"""

_COLLOCATIONS = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS x FROM d),
n AS (SELECT lang, CAST(sum(len(x)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, list_slice(x, i, i + m - 1) AS p FROM w, range(1, 6) t(m), LATERAL (SELECT unnest(range(1, len(x) - m + 2)) AS i)),
f AS (SELECT lang, p, count(*) AS f FROM g GROUP BY lang, p HAVING count(*) >= 100),
sub AS (SELECT DISTINCT b.lang, list_slice(b.p, i, i + m - 1) AS p, b.f
        FROM f b, range(2, 5) t(m), LATERAL (SELECT unnest(range(1, len(b.p) - m + 2)) AS i) WHERE len(b.p) > m),
longer AS (SELECT lang, p, max(f) AS f FROM sub GROUP BY lang, p),
kept AS (SELECT c.lang, c.p, c.f AS a FROM f c LEFT JOIN longer o ON o.lang = c.lang AND o.p = c.p
         WHERE len(c.p) > 1 AND (o.f IS NULL OR 100 * o.f < 100 * c.f)),
cuts AS (SELECT c.*, k, l.f AS l, r.f AS r, n.n,
                CAST((1000::HUGEINT * c.a * n.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
         FROM kept c JOIN n ON n.lang = c.lang, LATERAL (SELECT unnest(range(1, len(c.p))) AS k)
         JOIN f l ON l.lang = c.lang AND l.p = list_slice(c.p, 1, k)
         JOIN f r ON r.lang = c.lang AND r.p = list_slice(c.p, k + 1, len(c.p))),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
       array_to_string(p, ' ') AS phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000"""

#: Brute force; the query compares a table of up to ``min_window`` vectors whole, and larger ones by measured windows.
_NEAREST = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_transform(list_zip(q.v, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])) AS s
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
d AS (SELECT query_id, vec_id, sqrt(list_reduce(s, lambda x, y: x + y)) AS score FROM p)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM d QUALIFY rank <= 10"""

#: DuckDB SQL for the queries that SQL can express.
ORACLE = {"op1_mix_sources": _MIX, "op5_line_rules": _RULES, "op8_embedding_forest": _VECTORS,
          "op11_collocations": _COLLOCATIONS,
          "op12_nearest_vectors": _NEAREST, "op13_conversation_trie": _TRIE, "op9_chat_prefix_tree": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""}
