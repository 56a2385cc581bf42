"""Line deduplication: an exact set-similarity join in DataFrame operations only.

A line's tokens are its distinct runs of five words; words are what blanks separate. The
words of a shorter line are its one token. A line with words is removed when an earlier
line of the corpus, in the order of (doc_id, line number), is equal or has a Jaccard
similarity of 0.75 or more. Lines and tokens are named by 64-bit hashes: among n
different lines two get one name with a chance of about n^2 / 2^65.

1. Candidates. Any two such lines share one of the first n - ceil(0.75 n) + 1 tokens
   in any fixed order, and l of the first n - ceil(0.75 n) + l. Tokens with a long first
   word come first: they are rare, and the order needs no counts. Only lines that share
   enough of these tokens with other lines go on: no pair is lost.
2. Join of the candidates, numbered in the order of their first places. Each line first
   meets one hub, the earliest line that has an outermost token of its set; a line that
   matches it is settled. Only the others meet the earlier lines of their tokens, ordered
   by rarity: those that at most ``MANY`` candidates have come first, then the others by
   their count. Prefix, positional and length filters leave few pairs. Pairs of tokens with
   up to ``MANY`` lines are written and verified on the whole sets, the few tokens with more
   carry the sets along, so that only similar pairs leave their join.

A token's name is the length of its first word and 56 bits of its hash, so only lines that
are compared can have two tokens mixed up.
"""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrid.llm.common import SHINGLE, SIMILARITY, staged
from pricegrid.session import staged_while

#: Bits of the tables that drop most other rows before a shuffle.
TABLE_BITS = 1 << 23
#: Tokens of a line for each token taken beyond its prefix.
SPARE = 16
#: Candidate lines with a common token beyond which the token counts as common.
MANY = 32
#: Tokens of a line up to which its set travels with its common tokens.
CARRIED = 256
#: Bits that stand for a carried set, in words of 64; sets differ in at least as many tokens.
BIT_WORDS = 4
PART, WHOLE = SIMILARITY

ORACLE_SQL = f"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM d),
c AS (SELECT line, min({{'doc_id': doc_id, 'text': hash(text), 'line_no': line_no}}) AS first FROM l
      WHERE len(list_filter(string_split(line, ' '), lambda x: x <> '')) > 0 GROUP BY line),
s AS (SELECT line, first, list_filter(string_split(line, ' '), lambda x: x <> '') AS w FROM c),
t AS (SELECT line, first, CASE WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {SHINGLE - 2}),
          lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))) END AS tokens FROM s),
e AS (SELECT line, first, len(tokens) AS n, unnest(tokens) AS token FROM t),
p AS (SELECT a.line, a.n AS n, b.n AS m, count(*) AS shared FROM e a JOIN e b ON a.token = b.token AND b.first < a.first
      GROUP BY a.line, a.n, b.line, b.n),
near AS (SELECT DISTINCT line FROM p WHERE {WHOLE} * shared >= {PART} * (n + m - shared)),
gone AS (SELECT l.doc_id, l.text, l.line_no FROM l JOIN c USING (line) LEFT JOIN near ON near.line = l.line
      WHERE near.line IS NOT NULL OR l.doc_id <> c.first.doc_id OR l.line_no <> c.first.line_no)
SELECT docs.doc_id, len(string_split(coalesce(docs.text, ''), chr(10))) AS n_lines,
  coalesce(len(g.removed), 0) AS n_removed, coalesce(g.removed, []) AS removed
FROM documents docs
LEFT JOIN (SELECT doc_id, text, list(CAST(line_no - 1 AS INTEGER) ORDER BY line_no) AS removed FROM gone GROUP BY ALL) g
  ON g.doc_id = docs.doc_id AND g.text = coalesce(docs.text, '')"""


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line_no, line, line_key) of every line."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    ).withColumn("line_key", F.xxhash64("line"))


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, " "), "")


def _keys(line: Column) -> Column:
    """A number per word: its length, longest first in the order, and 56 bits of its hash."""
    return F.transform(
        _words(line),
        lambda w: F.shiftleft(F.negative(F.octet_length(w)).cast("long"), 56).bitwiseOR(F.shiftrightunsigned(F.xxhash64(w), 8)),
    )


def _tokens(line: Column) -> Column:
    """A line's distinct runs of five words, those with a long first word first; null for lines without words."""
    # one lambda over a one-element array names the keys, so they are computed once
    named = F.transform(
        F.array(_keys(line)),
        lambda h: F.when(F.size(h) > 0, F.transform(F.slice(h, 1, F.greatest(F.size(h) - (SHINGLE - 1), F.lit(1))), lambda x, i: _run(h, x, i))),
    )
    return F.sort_array(F.array_distinct(F.element_at(named, 1)))


def _run(h: Column, x: Column, i: Column) -> Column:
    """The token at place i: the length of its first word, as in the key x, and 56 bits of hash.

    Behind the end there is no word, so the words of a shorter line are one token.
    """
    run = F.xxhash64(x, *[F.get(h, i + k) for k in range(1, SHINGLE)])
    return x.bitwiseAND(F.lit(-1 << 56)).bitwiseOR(F.shiftrightunsigned(run, 8))


def _prefix_length(n: Column) -> Column:
    return n - F.ceil(n * PART / F.lit(WHOLE)).cast("int") + 1


def _spare(n: Column) -> Column:
    """Tokens taken beyond the prefix of n tokens, so that as many more are shared."""
    return F.floor(n / F.lit(SPARE)).cast("int")


def _prefixes(lines: DataFrame) -> DataFrame:
    """``token, line_key, need``: the first tokens of every line, those with the longest first words.

    Tokens come in the order of a number of their first words, a hash that every byte of the
    word halves. All up to that of enough different first words are taken, so there are
    enough different tokens among them, or all there are.
    Sets of which all but r tokens are common share l of their first r + l tokens: the
    first l common ones are among them. A line has at least as many tokens as different
    first words, and no partner with less than three quarters of them, which gives ``need``,
    the least number of shared tokens.
    """
    runs = F.greatest(F.size("w") - (SHINGLE - 1), F.lit(1))
    order = F.transform("w", lambda x: F.call_function("shiftrightunsigned", F.xxhash64(x), F.octet_length(x)))
    rows = lines.select("line_key", _words(F.col("line")).alias("w")).where(F.size("w") > 0)
    rows = rows.withColumn("order", order)
    rows = rows.withColumn("firsts", F.sort_array(F.array_distinct(F.slice("order", 1, runs))))
    last = F.get("firsts", _prefix_length(runs) + _spare(runs) - 1)
    need = F.when(last.isNull(), 1).otherwise(1 + _spare(F.size("firsts") * PART / F.lit(WHOLE)))
    rows = rows.select("line_key", "w", "order", last.alias("last"), need.alias("need"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), runs - 1)).alias("i"))
    rows = rows.where(F.col("last").isNull() | (F.get("order", F.col("i")) <= F.col("last")))
    return rows.select(F.xxhash64(*[F.get("w", F.col("i") + k) for k in range(SHINGLE)]).alias("token"), "line_key", "need")


def _candidates(rows: DataFrame, held: ExitStack) -> DataFrame:
    """Keys of the lines that share enough of their first tokens with other lines."""
    shared = (
        rows.groupBy("token")
        .agg(F.min("line_key").alias("low"), F.max("line_key").alias("high"))
        .where("low <> high")
        .select("token")
    )
    shared = held.enter_context(staged_while(shared, "line-shared"))
    met = rows.where(_in_table(_table(shared, "token"), "token"))
    met = met.join(shared.hint("shuffle_hash"), "token", "left_semi").distinct()
    return met.groupBy("line_key").agg(F.count("*").alias("c"), F.min("need").alias("need")).where("c >= need").select("line_key")


def _table(keys: DataFrame, name: str) -> Column:
    """Bits of the keys as one array of a fixed size, for a test before a shuffle.

    It lets some other keys through, more of them the more keys there are; the join
    that follows is exact.
    """
    spark, words = keys.sparkSession, TABLE_BITS // 64
    bit = F.col(name).bitwiseAND(F.lit(TABLE_BITS - 1))
    bits = (
        keys.select(F.shiftright(bit, 6).alias("id"), bit.bitwiseAND(F.lit(63)).cast("int").alias("at"))
        .groupBy("id")
        .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"))
    )
    dense = spark.range(words).join(bits, "id", "left")
    cells = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return dense.agg(F.transform(cells, lambda c: c["bits"]).alias("bits")).scalar()


def _in_table(table: Column, name: str) -> Column:
    bit = F.col(name).bitwiseAND(F.lit(TABLE_BITS - 1))
    word = F.get(table, F.shiftright(bit, 6).cast("int"))
    return F.call_function("shiftright", word, bit.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def _fits(n: str, i: str, m: str, j: str) -> Column:
    """Length filter, and positional filter for sets that first meet at places i and j."""
    a, b, p, q = F.col(n), F.col(m), F.col(i), F.col(j)
    length = F.least(a, b) * WHOLE >= F.greatest(a, b) * PART
    position = (F.least(a - p, b - q) + 1) * (WHOLE + PART) >= (a + b) * PART
    return length & position


def _similar(a: str, b: str) -> Column:
    both = F.size(F.array_intersect(a, b))
    return both * WHOLE >= (F.size(a) + F.size(b) - both) * PART


def _bits(s: Column, word: int) -> Column:
    """One word of a set's bits: every token sets one bit of all words together."""
    place = lambda x: x.bitwiseAND(F.lit(64 * BIT_WORDS - 1))
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), place(x).cast("int"))
    mine = F.filter(s, lambda x: F.shiftright(place(x), 6) == word)
    return F.aggregate(mine, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(bit(x)))


def _near_bits() -> Column:
    """False only for pairs whose bits tell that too many of their tokens differ."""
    differ = F.lit(0)
    for k in range(BIT_WORDS):
        differ = differ + F.bit_count(F.col(f"b{k}").bitwiseXOR(F.col(f"q_b{k}")))
    both = F.col("n") + F.col("m")
    return (both - differ) * (WHOLE + PART) >= both * (2 * PART)


def _later_of_common(rows: DataFrame, sets: DataFrame, settled: DataFrame, held: ExitStack) -> tuple[DataFrame, DataFrame]:
    """Pairs of lines that share a common token: later lines that are similar, pairs left to verify.

    ``rows`` are those of common tokens. Sets of up to ``CARRIED`` tokens are compared in
    the join itself; a pair with a longer one is left to the caller.
    """
    rows = held.enter_context(staged_while(rows, "line-common-places"))
    theirs = sets.where(F.size("s") <= CARRIED).join(rows.select("rank").distinct(), "rank", "left_semi")
    carried = theirs.select("rank", "s", *[_bits(F.col("s"), k).alias(f"b{k}") for k in range(BIT_WORDS)])
    rows = held.enter_context(staged_while(rows.join(carried, "rank", "left"), "line-common-rows"))
    names = {"rank": "q_rank", "n": "m", "i": "j", "s": "q_s"} | {f"b{k}": f"q_b{k}" for k in range(BIT_WORDS)}
    others = rows.select("token", *[F.col(c).alias(q) for c, q in names.items()])
    open_ = rows.join(settled.withColumnRenamed("later", "rank"), "rank", "left_anti")
    before = (F.col("q_rank") < F.col("rank")) & _fits("n", "i", "m", "j")
    known = F.col("s").isNotNull() & F.col("q_s").isNotNull()
    met = open_.join(others, "token").where(before & (~known | (_near_bits() & _similar("s", "q_s"))))
    met = met.select(F.col("rank").alias("later"), F.col("q_rank").alias("earlier"), known.alias("known")).distinct()
    met = held.enter_context(staged_while(met, "line-common-pairs"))
    return met.where("known").select("later").distinct(), met.where("NOT known").select("later", "earlier")


def _later(pairs: DataFrame, sets: DataFrame, held: ExitStack) -> DataFrame:
    """The later lines of the pairs ``(later, earlier)`` that are similar.

    Pairs are written first. Most lines have none, and a table of known size can be
    broadcast, so only the sets of lines with pairs are shuffled.
    """
    pairs = held.enter_context(staged_while(pairs, "line-pairs"))
    a = sets.select(F.col("rank").alias("later"), F.col("s").alias("a"))
    b = sets.select(F.col("rank").alias("earlier"), F.col("s").alias("b"))
    return pairs.join(a, "later").join(b, "earlier").where(_similar("a", "b")).select("later").distinct()


def _hubs(sets: DataFrame) -> DataFrame:
    """For each line the earliest line that has one of the outermost tokens of its set, as a pair."""
    ends = F.array_distinct(F.array(*[F.get("s", k) for k in (F.lit(0), F.lit(1), F.size("s") - 2, F.size("s") - 1)]))
    rows = sets.select("rank", F.explode(ends).alias("token")).where("token IS NOT NULL")
    hubs = rows.groupBy("token").agg(F.min("rank").alias("earlier"), F.max("rank").alias("last")).where("earlier < last")
    met = rows.join(hubs, "token").where("earlier < rank").groupBy("rank", "earlier").agg(F.count("*").alias("c"))
    return met.groupBy(F.col("rank").alias("later")).agg(F.max_by("earlier", "c").alias("earlier"))


def _near(lines: DataFrame, ids: DataFrame, held: ExitStack) -> DataFrame:
    """Keys of lines that a different, earlier line matches; ``ids`` has ``line_key, rank`` of the candidates."""

    def kept(df: DataFrame, name: str) -> DataFrame:
        return held.enter_context(staged_while(df, name))

    sets = (
        lines.where(_in_table(_table(ids, "line_key"), "line_key"))
        .groupBy("line_key")
        .agg(F.first("line").alias("line"))
        .join(ids, "line_key")
        .select("line_key", "rank", _tokens(F.col("line")).alias("s"))
        .withColumn("n", F.size("s"))
    )
    sets = kept(sets, "line-sets")
    settled = kept(_later(_hubs(sets), sets, held), "line-settled")
    each = F.posexplode(F.slice("s", 1, _prefix_length(F.col("n")))).alias("i", "token")
    met = sets.select("rank", "n", each).select("token", "rank", "n", F.expr("i + 1").alias("i"))
    # Tokens of many lines come last in the order. That changes the prefix of the lines
    # that have one in it; their next tokens move up, and only these sets are taken apart.
    common = kept(met.groupBy("token").agg(F.count("*").alias("lines")).where(F.col("lines") > MANY), "line-common")
    moved = met.join(common.select("token"), "token", "left_semi").select("rank").distinct()
    moved = kept(moved, "line-moved")
    each = sets.join(moved, "rank", "left_semi").select("rank", "n", F.explode("s").alias("token"))
    ranked = each.join(common, "token", "left").selectExpr(
        "token", "rank", "n",
        "row_number() OVER (PARTITION BY rank ORDER BY coalesce(lines, 0), token) AS i",
    )
    ranked = ranked.where(F.col("i") <= _prefix_length(F.col("n")))
    rows = met.join(moved, "rank", "left_anti").unionByName(ranked)
    rows = kept(rows, "line-prefixes")

    # a token can only be common now if it was before, or moved up
    most = kept(rows.groupBy("token").agg(F.count("*").alias("lines")).where(F.col("lines") > MANY).select("token"), "line-most")
    similar, more = _later_of_common(rows.join(most, "token", "left_semi"), sets, settled, held)
    cool = rows.join(most, "token", "left_anti")
    open_ = cool.join(settled.withColumnRenamed("later", "rank"), "rank", "left_anti")
    others = cool.select("token", F.col("rank").alias("earlier"), F.col("n").alias("m"), F.col("i").alias("j"))
    pairs = open_.withColumnRenamed("rank", "later").join(others, "token").where((F.col("earlier") < F.col("later")) & _fits("n", "i", "m", "j"))
    rest = _later(pairs.select("later", "earlier").unionByName(more).distinct(), sets, held)
    found = settled.unionByName(similar).unionByName(rest).distinct()
    return ids.join(found.withColumnRenamed("later", "rank"), "rank", "left_semi").select("line_key")


def _gone(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, gone): numbers of the lines to remove, for documents that lose some."""
    lines = _lines(docs)
    place = F.struct("doc_id", "text_key", "line_no")
    with ExitStack() as held:
        places = lines.where(F.length(F.translate("line", " ", "")) > 0).select("doc_id", "text_key", "line_no", "line_key")
        places = held.enter_context(staged_while(places, "line-places"))
        with ExitStack() as early:  # the tokens go once the candidates are known
            rows = early.enter_context(staged_while(_prefixes(lines), "line-tokens"))
            keys = held.enter_context(staged_while(_candidates(rows, early), "line-candidates"))
        owners = places.groupBy("line_key").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
        owners = held.enter_context(staged_while(owners, "line-owners"))
        # numbers in the order of the places, which is written to sort it once
        ids = held.enter_context(staged_while(owners.join(keys, "line_key", "left_semi").select("line_key", "first"), "line-firsts"))
        ids = ids.orderBy("first").select("line_key", F.monotonically_increasing_id().alias("rank"))
        ids = held.enter_context(staged_while(ids, "line-ids"))
        near = held.enter_context(staged_while(_near(lines.select("line", "line_key"), ids, held), "line-near"))
        repeated = (
            owners.join(near.withColumn("near", F.lit(True)), "line_key", "left")
            .where("copies > 1 OR near")
            .select("line_key", "first", F.coalesce("near", F.lit(False)).alias("near"))
        )
        hit = places.join(repeated, "line_key").where(F.col("near") | (place != F.col("first")))
        return staged(hit.groupBy("doc_id", "text_key").agg(F.collect_set("line_no").alias("gone")), "line-gone")


def _cleaned(docs: DataFrame) -> DataFrame:
    """``d``, a struct of each row of ``docs``, with its ``gone`` lines and the ``kept`` text."""
    gone = _gone(docs).toDF("id", "key", "gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    text = F.coalesce(F.col("d.text").cast("string"), F.lit(""))
    joined = rows.join(gone, F.col("d.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(text) == F.col("key")), "left")
    parts = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    return joined.select("d", "gone", F.when(F.col("gone").isNull(), text).otherwise(kept).alias("kept"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that repeat earlier ones, all columns kept in their order.

    A document that loses its last line is dropped, one without any text stays. Where
    there is a column ``n_chars`` it is counted anew. Blank lines stay. Null text counts
    as empty and stays null; null doc_id comes first in the order. Rows with equal doc_id
    and text are one document delivered again: they keep and lose the same lines. A line
    of any length is one set of tokens.
    """
    done = _cleaned(docs).where("gone IS NULL OR kept <> ''")
    columns = []
    for name in docs.columns:
        own = F.col("d").getField(name)
        if name == "text":
            own = F.when(own.isNotNull(), F.col("kept"))
        elif name == "n_chars":
            own = F.when(F.col("gone").isNull(), own).otherwise(F.length("kept")).cast(docs.schema["n_chars"].dataType)
        columns.append(own.alias(name))
    return done.select(*columns)


def line_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` of every row, emptied documents too.

    ``removed`` has the numbers of the lines that :func:`dedup_lines` takes out, from 0
    and ascending. Texts are not moved.
    """
    gone = _gone(docs).toDF("__id", "__key", "__gone")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("__own"),
        F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
    )
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key")), "left")
    return joined.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.sort_array("__gone"), F.array().cast("array<int>")).alias("removed"),
    )
