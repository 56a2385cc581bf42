"""The operators as queries on whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.llm import (
    chat,
    decontaminate,
    exact_dedup,
    filter_audit,
    importance,
    jaccard_join,
    line_dedup,
    mixing,
    pii,
    quality,
    suffix_dedup,
    toxicity,
    warc,
)
from pricegrid.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return keep


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op1_decontaminate")
def op1_decontaminate(spark, sf_dir):
    """Every pair of a document and a benchmark item that it repeats."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op2_exact_dedup",
    f"""
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)""",
)
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest")


@query("op3_pii")
def op3_pii(spark, sf_dir):
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


_BITS = """list_aggregate(list_transform(range(1, 41), lambda i:
  lpad(bin(strpos('0123456789abcdef', substr(h, i, 1)) - 1), 4, '0')), 'string_agg', '')"""
_BASE32 = """list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
  + 16 * CAST(substr(bits, CAST(5 * i + 1 AS INT), 1) AS INT) + 8 * CAST(substr(bits, CAST(5 * i + 2 AS INT), 1) AS INT)
  + 4 * CAST(substr(bits, CAST(5 * i + 3 AS INT), 1) AS INT) + 2 * CAST(substr(bits, CAST(5 * i + 4 AS INT), 1) AS INT)
  + CAST(substr(bits, CAST(5 * i + 5 AS INT), 1) AS INT), 1)), 'string_agg', '')"""


@query(
    "op4_warc",
    f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
b AS (SELECT page_id, html, sha1(html) AS h FROM p),
c AS (SELECT page_id, html, {_BITS} AS bits FROM b)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = max(page_id) OVER w THEN NULL ELSE max(page_id) OVER w END AS refers_to
FROM c WINDOW w AS (PARTITION BY html)""",
)
def op4_warc(spark, sf_dir):
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.checked_revisits(warc.read_archives(archives, content=False)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query(
    "op5_jaccard_join",
    rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
  FROM w),
n AS (SELECT doc_id, len(shingles) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
linked AS (SELECT p.a, p.b FROM pairs p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * p.both >= 75 * (x.n_shingles + y.n_shingles - p.both)),
reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, l.b FROM reach r JOIN linked l ON l.a = r.b)
SELECT n.doc_id, n.n_shingles, m.component_id
FROM n JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = n.doc_id""",
)
def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op6_quality")
def op6_quality(spark, sf_dir):
    """Sources are the hosts, and a source's languages its paths."""
    return quality.quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), host=F.col("source"), path=F.col("lang")
    )


@query("op7_line_dedup", line_dedup.ORACLE_SQL)
def op7_line_dedup(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


CONTROL = "<|im_end|><|im_start|>assistant ok"


@query(
    "op9_chat",
    rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')),
s AS (SELECT *, coalesce(lag(role) OVER w, '') AS before, lead(role) OVER w AS after FROM c
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + length(regexp_replace(text, '<(\\*)\|', '<|\1_', 'g'))
    + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars,
  bool_and(CASE role WHEN 'system' THEN before = '' WHEN 'user' THEN before IN ('', 'system', 'assistant')
    WHEN 'assistant' THEN before = 'user' ELSE false END AND (after IS NOT NULL OR role = 'assistant')) AS valid
FROM s GROUP BY conv_id""",
)
def op9_chat(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    shape = T.StructType.fromDDL("conv_id long, turn long, role string, text string")
    own = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], shape)
    segments = chat.format_conversations(rows.unionByName(own))
    return chat.read_back(segments, in_order=True)


# Target weights of the mix, from the root down; sources not named weigh 1.
DOMAINS = {"web": ("src0", "src1", "src2", "src3", "src4"), "books": ("src5", "src6", "src7", "src8", "src9"),
           "forums": ("src10", "src11", "src12", "src13", "src14")}
WEIGHTS = {
    "domain": {"web": 40, "books": 30, "forums": 20, "other": 10},
    "lang": {"en": 50, "de": 20, "fr": 20, "es": 10},
    "source": {"src0": 2},
}
MIX_SEED, MIX_EPOCHS = 7, 2


def domain_of(source):
    out = F.lit("other")
    for name, sources in DOMAINS.items():
        out = F.when(source.isin(*sources), F.lit(name)).otherwise(out)
    return out


def levels():
    return {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def _case(column: str, names: dict[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {v}" for k, v in names.items()) + " ELSE 1 END"


def _share(name: str, parent: str, level: str, inner: str) -> str:
    """SQL for one step down the tree: rows of ``inner`` (parent columns, node, room, weight, budget)."""
    part = f"PARTITION BY {parent}" if parent else ""
    lead = f"{parent}, " if parent else ""
    return f"""{name}_r AS (SELECT *, room / weight AS ratio,
  coalesce(sum(room) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room_before,
  sum(weight) OVER ({part}) - coalesce(sum(weight) OVER (b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_left
  FROM ({inner}) WINDOW b AS ({part} ORDER BY room / weight, weight, node)),
{name}_s AS (SELECT *, greatest(budget - room_before, 0) AS budget_left FROM {name}_r),
{name}_f AS (SELECT *, min(CASE WHEN CAST(budget_left AS DOUBLE) * CAST(weight AS DOUBLE) / CAST(weight_left AS DOUBLE) < room
    THEN {{'ratio': ratio, 'weight': weight, 'node': node, 'budget_left': budget_left, 'weight_left': weight_left}} END)
  OVER ({part}) AS rest FROM {name}_s),
{name} AS (SELECT {lead}node AS {level}, CAST(CASE WHEN rest IS NOT NULL
    AND {{'ratio': ratio, 'weight': weight, 'node': node}} >= {{'ratio': rest.ratio, 'weight': rest.weight, 'node': rest.node}}
  THEN least(CAST(floor(CAST(rest.budget_left AS DOUBLE) * CAST(weight AS DOUBLE) / CAST(rest.weight_left AS DOUBLE)) AS BIGINT), room)
  ELSE room END AS BIGINT) AS budget FROM {name}_f)"""


def mixing_sql(source: str = "documents", columns: str = "doc_id, domain, lang, source, tokens, copies") -> str:
    domain = "CASE " + " ".join(
        "WHEN source IN (" + ", ".join(f"'{s}'" for s in sources) + f") THEN '{name}'" for name, sources in DOMAINS.items()
    ) + " ELSE 'other' END"
    return rf"""
d AS (SELECT doc_id, {domain} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM {source}),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens,
  {_case("domain", WEIGHTS["domain"])} AS wd, {_case("lang", WEIGHTS["lang"])} AS wl, {_case("source", WEIGHTS["source"])} AS ws,
  CAST(sum(tokens) * {MIX_EPOCHS} AS BIGINT) AS room FROM d GROUP BY 1, 2, 3),
{_share("g1", "", "domain", "SELECT domain AS node, CAST(sum(room) AS BIGINT) AS room, max(wd) AS weight, (SELECT CAST(sum(tokens) AS BIGINT) FROM leaf) AS budget FROM leaf WHERE room > 0 GROUP BY domain")},
{_share("g2", "domain", "lang", "SELECT domain, lang AS node, CAST(sum(room) AS BIGINT) AS room, max(wl) AS weight, any_value(budget) AS budget FROM leaf JOIN g1 USING (domain) WHERE room > 0 GROUP BY domain, lang")},
{_share("g3", "domain, lang", "source", "SELECT domain, lang, source AS node, room, ws AS weight, budget FROM leaf JOIN g2 USING (domain, lang) WHERE room > 0")},
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
  CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM leaf JOIN g3 USING (domain, lang, source)),
placed AS (SELECT d.*, whole, rest, md5('{MIX_SEED}:' || whole || ':' || doc_id) AS place FROM d JOIN plan USING (domain, lang, source)),
run AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto FROM placed),
chosen AS (SELECT doc_id, domain, lang, source, tokens, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS copies FROM run)
SELECT {columns} FROM chosen WHERE copies > 0"""


@query("op10_mixing", "WITH " + mixing_sql().strip())
def op10_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"), None, WEIGHTS, levels(), MIX_EPOCHS, MIX_SEED)


@query(
    "op11_suffix_dedup",
    """
WITH d AS (SELECT DISTINCT coalesce(doc_id, -9223372036854775808) AS id, coalesce(text, '') AS text FROM documents),
x AS (SELECT id, sha256(text) AS key, hex(encode(text)) AS hx, octet_length(encode(text)) AS n FROM d),
s AS (SELECT id, key, i, substr(hx, CAST(2 * i + 1 AS INTEGER), 200) AS piece FROM (
  SELECT *, unnest(range(0, n - 99)) AS i FROM x WHERE n >= 100)),
late AS (SELECT id, key, i FROM (
  SELECT *, row_number() OVER (PARTITION BY piece ORDER BY id, key, i) AS nth FROM s) WHERE nth > 1),
edge AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY id, key ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM late),
span AS (SELECT id, key, min(i) AS a, max(i) + 100 AS b FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY id, key ORDER BY i) AS nr FROM edge) GROUP BY id, key, nr),
gap AS (SELECT id, key, a, b, coalesce(lag(b) OVER (PARTITION BY id, key ORDER BY a), 0) AS before FROM span),
cut AS (SELECT id, key, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
    string_agg(substr(hx, CAST(2 * before + 1 AS INTEGER), CAST(2 * (a - before) AS INTEGER)), '' ORDER BY a) AS kept
  FROM gap JOIN x USING (id, key) GROUP BY id, key)
SELECT docs.doc_id, CAST(x.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN tail IS NULL THEN hx ELSE kept || substr(hx, CAST(2 * tail + 1 AS INTEGER)) END)) AS kept_sha256
FROM documents docs
JOIN x ON x.id = coalesce(docs.doc_id, -9223372036854775808) AND x.key = sha256(coalesce(docs.text, ''))
LEFT JOIN cut ON cut.id = x.id AND cut.key = x.key""",
)
def op11_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"))


def _features(name: str) -> str:
    return rf"""SELECT * FROM (SELECT *, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM {name})"""


@query(
    "op12_importance",
    rf"""
WITH f AS ({_features("(SELECT doc_id, row_number() OVER () AS r, text FROM documents)")}),
g AS ({_features("benchmark")}),
crc AS (SELECT list(list_reduce([n] || range(0, 8), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY n) AS lut
  FROM range(0, 256) r(n)),
words AS (SELECT word, hex(encode(word)) AS hx FROM (SELECT word FROM f UNION SELECT word FROM g)),
b AS (SELECT word, xor(list_reduce([4294967295] || list_transform(range(0, len(hx) // 2), lambda i:
      CAST(16 * (strpos('0123456789ABCDEF', substr(hx, CAST(2 * i + 1 AS INTEGER), 1)) - 1)
        + strpos('0123456789ABCDEF', substr(hx, CAST(2 * i + 2 AS INTEGER), 1)) - 1 AS BIGINT)),
    lambda c, x: xor(c >> 8, lut[CAST((xor(c, x) & 255) + 1 AS INTEGER)])), 4294967295) % {importance.BUCKETS} AS bucket
  FROM words, crc),
s AS (SELECT bucket, count(*) AS s FROM f JOIN b USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM g JOIN b USING (word) GROUP BY bucket),
gains AS (SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1.0::DOUBLE) * (SELECT sum(s) + {importance.BUCKETS} FROM s)::DOUBLE)
  / ((s + 1.0::DOUBLE) * (SELECT coalesce(sum(t), 0) + {importance.BUCKETS} FROM t)::DOUBLE))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT r, count(*) AS n, sum(gain) AS weight FROM f JOIN b USING (word) JOIN gains USING (bucket) GROUP BY r),
h AS (SELECT doc_id, r, CAST('0x' || left(sha256('{importance.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) AS h
  FROM (SELECT doc_id, row_number() OVER () AS r FROM documents)),
x AS (SELECT doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
  CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM h LEFT JOIN w USING (r)),
o AS (SELECT *, CASE WHEN n_features >= {importance.LEAST_WORDS} THEN row_number() OVER (
  PARTITION BY n_features >= {importance.LEAST_WORDS} ORDER BY score DESC, doc_id NULLS FIRST) END AS nth FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN nth <= (SELECT count(nth) * {importance.SHARE[0]} // {importance.SHARE[1]} FROM o) THEN nth END AS rank
FROM o""",
)
def op12_importance(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_filter_audit", filter_audit.ORACLE_SQL)
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
