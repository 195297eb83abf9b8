"""Operator 10: chat formatting by quotation linking. DataFrame functions only.

A message's lines are parsed for nested quote marks (``>``). Consecutive lines
of one level make a passage: its words are those of its lines, quote marks off,
lower case, white space runs as one space, so a quote that was wrapped anew
reads like the original. A quoted passage is hashed by its keys: windows of
``WINDOW`` words one after the other and the last one, or the whole passage if
it is shorter. An original offers every window of its passages, and as a whole
each passage, line and sentence that is shorter than a window.

A key links to the latest earlier message of the conversation that offers it;
a quoted level to the message that most of its keys link to (ties: the latest),
and the message answers what its shallowest linked level quotes. Replies hang
below the message they quote: a thread is named by the turn at its root, found
by pointer jumping, and a conversation is read by thread, and in it each message
with all its answers before the next one. Quotes, and
the attribution line that leads one, are taken out of the text; a message
without quotes stays as it is, white space included.

Windows are made for messages of conversations with quotes only. The latest
earlier writer is found in two steps, in blocks of ``BLOCK`` turns and then over
blocks, so a line that everybody writes, in a conversation that holds a third of
all messages, is in no task as a whole and no pairs of writers and quoters are
made. The rows of a conversation are laid out by a global sort, never gathered.

Defined results: a null text is empty; a null conv_id is one conversation of its
own, a null turn comes first, is never replied to and links nothing; a null role
is ``user``; repeated rows get a row each; quotes that match no earlier message
are removed and link nothing; other columns of the input are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import cut, load

WINDOW = 5
BLOCK = 4096
BROADCAST_ROWS = 100_000
QUOTE = r"^\\s{0,3}(>[>\\s]*)"  # one class under the star: matched in a loop, however many levels a line has
ATTRIBUTION = r"(?i)^(?:on .{1,200} wrote|le .{1,200} a écrit|am .{1,200} schrieb|el .{1,200} escribió)\\s*:\\s*$"


def parse(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, content and passages: array of (depth, lines, text) with a word."""
    m = messages.select("conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("__t"))
    m = m.withColumn("__l", F.expr(
        f"if(contains(__t, '>'), transform(split(__t, '\n', -1), l -> struct(length(regexp_replace(regexp_extract(l, '{QUOTE}', 1), '[^>]', '')) as depth,"
        f" regexp_replace(l, '{QUOTE}', '') as line)), array(struct(0 as depth, __t as line)))"))
    m = m.withColumn("__s", F.expr("filter(sequence(0, size(__l) - 1), i -> i = 0 or __l[i].depth <> __l[greatest(i - 1, 0)].depth)"))
    clean = "lower(btrim(regexp_replace({}, '\\\\s+', ' '), ' '))"
    m = m.withColumn("passages", F.expr(
        "filter(transform(transform(__s, (s, k) -> struct(__l[s].depth as depth, array_join(transform(slice(__l, s + 1,"
        f" if(k < size(__s) - 1, __s[least(k + 1, size(__s) - 1)], size(__l)) - s), x -> x.line), '\n') as raw)),"
        f" x -> struct(x.depth as depth, x.raw as raw, {clean.format('x.raw')} as text)), x -> x.text <> '')"))
    # kept: unquoted lines that don't introduce a quote
    m = m.withColumn("content", F.expr(
        "if(not exists(__l, x -> x.depth > 0), __t, btrim(array_join(transform(filter(transform(__l, (x, i) -> struct(x.depth as depth, x.line as line,"
        f" i < size(__l) - 1 and x.line rlike '{ATTRIBUTION}' and __l[least(i + 1, size(__l) - 1)].depth > 0 as leads)),"
        " x -> x.depth = 0 and not x.leads), x -> x.line), '\n'), '\r\n'))"))
    return m.drop("__t", "__l", "__s")


def _window(at: str) -> str:
    return f"concat_ws(' ', slice(w, {at} + 1, {WINDOW}))"


def quoted_keys(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, depth, key of every quoted passage."""
    q = parsed.where("turn IS NOT NULL AND exists(passages, x -> x.depth > 0)").select("conv_id", "turn", F.explode("passages").alias("x")).where("x.depth > 0")
    q = q.select("conv_id", "turn", "x.depth", "x.text", F.split("x.text", " ").alias("w"))
    places = f"if(size(w) < {WINDOW}, array(0), array_distinct(concat(sequence(0, size(w) - {WINDOW}, {WINDOW}), array(size(w) - {WINDOW}))))"
    return q.select("conv_id", "turn", "depth", F.expr(f"explode(transform({places}, i -> xxhash64(if(size(w) < {WINDOW}, text, {_window('i')}))))").alias("key")).distinct()


def offered_keys(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, key of every unquoted passage."""
    o = parsed.where("turn IS NOT NULL").select("conv_id", "turn", F.explode("passages").alias("x")).where("x.depth = 0")
    o = o.select("conv_id", "turn", "x.text", "x.raw", F.split("x.text", " ").alias("w"))
    parts = (
        "filter(transform(concat(array(text), split(raw, '\n'), split(regexp_replace(text, '([.!?]) ', '$1\n'), '\n')),"
        f" x -> lower(btrim(regexp_replace(x, '\\\\s+', ' '), ' '))), x -> x <> '' and size(split(x, ' ')) < {WINDOW})")
    windows = f"if(size(w) < {WINDOW}, cast(array() as array<bigint>), transform(sequence(0, size(w) - {WINDOW}), i -> xxhash64({_window('i')})))"
    return o.select("conv_id", "turn", F.expr(f"explode(array_distinct(concat({windows}, transform({parts}, x -> xxhash64(x)))))").alias("key"))


def latest_earlier(asked: DataFrame, offered: DataFrame) -> DataFrame:
    """conv_id, turn, key, origin: for each row of ``asked`` the largest turn below its own that offers the key; none, no row.

    Turns meet in blocks; a block's largest turn is found by aggregation and
    stands for it where later blocks ask.
    """
    block = F.expr(f"floor(turn / {BLOCK})").alias("block")
    both = offered.select("conv_id", "key", "turn", F.lit(True).alias("offers")).unionByName(
        asked.select("conv_id", "key", "turn", F.lit(False).alias("offers"))).groupBy("conv_id", "key", "turn").agg(
        F.max("offers").alias("offers"), F.min("offers").alias("__all")).select("conv_id", "key", "turn", "offers", (~F.col("__all")).alias("asks"), block)
    before = "(PARTITION BY conv_id, key{} ORDER BY {} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    here = both.withColumn("near", F.expr(f"max(if(offers, turn, null)) OVER {before.format(', block', 'turn')}")).where("asks")
    blocks = both.groupBy("conv_id", "key", "block").agg(F.max(F.expr("if(offers, turn, null)")).alias("last"), F.max("asks").alias("asks"))
    blocks = blocks.withColumn("far", F.expr(f"max(last) OVER {before.format('', 'block')}")).where("asks AND far IS NOT NULL").select(
        F.col("conv_id").alias("bc"), F.col("key").alias("bk"), F.col("block").alias("bb"), "far")
    same = here["conv_id"].eqNullSafe(F.col("bc")) & (here["key"] == F.col("bk")) & (here["block"] == F.col("bb"))
    return here.join(blocks, same, "left").select("conv_id", "turn", "key", F.coalesce("near", "far").alias("origin")).where("origin IS NOT NULL")


def replies(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, reply_to, n_linked (keys with an origin): one row for each message with a linked quote."""
    asked = cut(quoted_keys(parsed))
    talks = asked.select(F.col("conv_id").alias("qc")).distinct()
    if asked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        talks = F.broadcast(talks)
    offered = offered_keys(parsed.join(talks, parsed["conv_id"].eqNullSafe(talks["qc"]), "left_semi"))
    wanted = asked.select(F.col("conv_id").alias("wc"), F.col("key").alias("wk")).distinct()
    offered = offered.join(wanted, offered["conv_id"].eqNullSafe(wanted["wc"]) & (offered["key"] == wanted["wk"]), "left_semi")
    origin = latest_earlier(asked.select("conv_id", "turn", "key"), offered).select(
        F.col("conv_id").alias("oc"), F.col("turn").alias("ot"), F.col("key").alias("ok"), "origin")
    hit = asked.join(origin, asked["conv_id"].eqNullSafe(origin["oc"]) & (asked["turn"] == origin["ot"]) & (asked["key"] == origin["ok"]))
    levels = hit.groupBy("conv_id", "turn", "depth", "origin").agg(F.count("*").alias("n"))
    return levels.groupBy("conv_id", "turn").agg(
        F.min_by("origin", F.struct("depth", (-F.col("n")).alias("many"), (-F.col("origin")).alias("late"))).alias("reply_to"), F.sum("n").alias("n_linked"))


def threads(links: DataFrame) -> DataFrame:
    """conv_id, turn, root, level, place of every message with a link or a reply.

    ``place`` counts a thread's messages in reply order: each below the one it
    answers, with all its own answers before the next answer to that one. It is
    the sum, on the way to the root, of one and the sizes of earlier siblings'
    branches. Sizes and sums come by pointer jumping: each round doubles the way.
    """
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    nodes = links.select("conv_id", "turn", F.col("reply_to").alias("up"))
    roots = nodes.select("conv_id", F.col("up").alias("turn")).distinct().join(nodes.select(F.col("conv_id").alias("nc"), F.col("turn").alias("nt")),
                                                                               F.col("conv_id").eqNullSafe(F.col("nc")) & (F.col("turn") == F.col("nt")), "left_anti")
    nodes = nodes.unionByName(roots.select("conv_id", "turn", F.lit(None).cast(nodes.schema["up"].dataType).alias("up")))
    same = lambda a, b: a["conv_id"].eqNullSafe(F.col("pc")) & (a[b] == F.col("pt"))

    # how many messages each has in its branch: after round k, those less than 2**k below
    at = cut(nodes.withColumn("size", one))
    while at.where("up IS NOT NULL").take(1):
        more = at.where("up IS NOT NULL").groupBy(F.col("conv_id").alias("pc"), F.col("up").alias("pt")).agg(F.sum("size").alias("more"))
        grown = at.join(more, same(at, "turn"), "left").select("conv_id", "turn", "up", (F.col("size") + F.coalesce("more", zero)).alias("size"))
        up = at.select(F.col("conv_id").alias("pc"), F.col("turn").alias("pt"), F.col("up").alias("further"))
        at = cut(grown.join(up, same(grown, "up"), "left").select("conv_id", "turn", F.col("further").alias("up"), "size"))

    # earlier siblings: within blocks of turns, and whole blocks before
    size = at.select(F.col("conv_id").alias("pc"), F.col("turn").alias("pt"), "size")
    kin = nodes.join(size, same(nodes, "turn")).select("conv_id", "turn", "up", "size", F.expr(f"floor(turn / {BLOCK})").alias("block"))
    blocks = kin.groupBy("conv_id", "up", "block").agg(F.sum("size").alias("n"))
    blocks = blocks.select(F.col("conv_id").alias("bc"), F.col("up").alias("bu"), F.col("block").alias("bb"), F.expr("sum(n) OVER (PARTITION BY conv_id, up ORDER BY block) - n").alias("before"))
    kin = kin.where("up IS NOT NULL").withColumn("near", F.expr("sum(size) OVER (PARTITION BY conv_id, up, block ORDER BY turn) - size"))
    steps = kin.join(blocks, kin["conv_id"].eqNullSafe(F.col("bc")) & (kin["up"] == F.col("bu")) & (kin["block"] == F.col("bb"))).select(
        "conv_id", "turn", "up", (F.col("near") + F.col("before") + 1).alias("place"))

    at = cut(steps.select("conv_id", "turn", F.col("up").alias("root"), one.alias("level"), "place"))
    while True:
        up = at.select(F.col("conv_id").alias("pc"), F.col("turn").alias("pt"), F.col("root").alias("pr"), F.col("level").alias("pl"), F.col("place").alias("pp"))
        moved = at.join(up, same(at, "root"), "left")
        if not at.take(1) or not moved.where("pr IS NOT NULL").take(1):
            return at
        at = cut(moved.select("conv_id", "turn", F.coalesce("pr", "root").alias("root"), (F.col("level") + F.coalesce("pl", zero)).alias("level"), (F.col("place") + F.coalesce("pp", zero)).alias("place")))


def conversations(messages: DataFrame) -> DataFrame:
    """One row a message, sorted so that a conversation's rows follow each other in reply order."""
    parsed = parse(messages)
    links = cut(replies(parsed))
    found = threads(links)
    found = found.join(links.select(F.col("conv_id").alias("lc"), F.col("turn").alias("lt"), "reply_to", "n_linked"),
                       found["conv_id"].eqNullSafe(F.col("lc")) & (found["turn"] == F.col("lt"))).select(
        F.col("conv_id").alias("fc"), F.col("turn").alias("ft"), "root", "level", "place", "reply_to", "n_linked")
    m = parsed.join(found, parsed["conv_id"].eqNullSafe(found["fc"]) & (parsed["turn"] == found["ft"]), "left")
    zero = F.lit(0).cast("long")
    return m.select(
        "conv_id", "turn", "role", "content",
        F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("content"), F.lit("<|end|>")).alias("formatted"),
        "reply_to", F.coalesce("root", "turn").alias("thread"), F.coalesce("level", zero).alias("level"),
        F.expr("cast(size(filter(passages, x -> x.depth > 0)) as bigint)").alias("n_quoted"),
        F.expr("cast(coalesce(array_max(transform(passages, x -> x.depth)), 0) as bigint)").alias("max_depth"),
        F.coalesce("n_linked", zero).alias("n_linked"), F.coalesce("place", zero).alias("__place"),
    ).orderBy("conv_id", "thread", "__place", "turn", "role", "content").drop("__place")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of the whole table in its reply-ordered conversation."""
    return conversations(load(spark, sf_dir, "conversations"))


def _oracle() -> str:
    """DuckDB SQL: lines by splitting, passages by runs, latest earlier writers by a join, threads by recursion."""
    space = r"[ \t\n\x0B\f\r]"
    quote = rf"^{space}{{0,3}}(>[>\t\n\x0B\f\r ]*)"
    attribution = ATTRIBUTION.replace("\\\\", "\\").replace(r"\s", space)
    clean = lambda x: f"lower(trim(regexp_replace({x}, '{space}+', ' ', 'g'), ' '))"
    key = "array_to_string(w[i + 1:i + {}], ' ')".format(WINDOW)
    return rf"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS t FROM conversations),
s AS (SELECT r, unnest(string_split(t, chr(10))) AS l, unnest(range(len(string_split(t, chr(10))))) AS i FROM t),
d AS (SELECT r, i, length(regexp_replace(regexp_extract(l, '{quote}', 1), '[^>]', '', 'g')) AS depth, regexp_replace(l, '{quote}', '') AS line FROM s),
n AS (SELECT *, coalesce(depth <> lag(depth) OVER (PARTITION BY r ORDER BY i), true) AS opens,
  coalesce(lead(depth) OVER (PARTITION BY r ORDER BY i) > 0 AND regexp_matches(line, '{attribution}'), false) AS leads FROM d),
g AS (SELECT *, sum(opens::INT) OVER (PARTITION BY r ORDER BY i) AS run FROM n),
p AS (SELECT r, run, depth, string_agg(line, chr(10) ORDER BY i) AS raw FROM g GROUP BY r, run, depth),
x AS (SELECT p.r, conv_id, turn, depth, raw, {clean('raw')} AS norm, string_split({clean('raw')}, ' ') AS w FROM p JOIN t USING (r) WHERE {clean('raw')} <> ''),
c AS (SELECT r, trim(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (depth = 0 AND NOT leads), ''), chr(13) || chr(10)) AS content, max(depth) > 0 AS quotes FROM n GROUP BY r),
v AS (SELECT r, count(*) FILTER (depth > 0) AS n_quoted, max(depth)::BIGINT AS max_depth FROM x GROUP BY r),
q AS (SELECT conv_id, turn, depth, norm AS key FROM x WHERE depth > 0 AND len(w) < {WINDOW} AND turn IS NOT NULL
  UNION SELECT conv_id, turn, depth, {key} FROM (SELECT conv_id, turn, depth, w, unnest(list_append(range(0, len(w) - {WINDOW} + 1, {WINDOW}), len(w) - {WINDOW})) AS i FROM x WHERE depth > 0 AND len(w) >= {WINDOW} AND turn IS NOT NULL)),
u AS (SELECT conv_id, turn, unnest(list_concat([norm], list_concat(string_split(raw, chr(10)), string_split(regexp_replace(norm, '([.!?]) ', '' || chr(10), 'g'), chr(10))))) AS part FROM x WHERE depth = 0 AND turn IS NOT NULL),
o AS (SELECT conv_id, turn, {clean('part')} AS key FROM u WHERE {clean('part')} <> '' AND len(string_split({clean('part')}, ' ')) < {WINDOW}
  UNION SELECT conv_id, turn, {key} FROM (SELECT conv_id, turn, w, unnest(range(0, len(w) - {WINDOW} + 1)) AS i FROM x WHERE depth = 0 AND len(w) >= {WINDOW} AND turn IS NOT NULL)),
h AS (SELECT q.conv_id, q.turn, depth, q.key, max(o.turn) AS origin FROM q JOIN o ON q.conv_id IS NOT DISTINCT FROM o.conv_id AND q.key = o.key AND o.turn < q.turn GROUP BY ALL),
b AS (SELECT conv_id, turn, depth, origin, count(*) AS n FROM h GROUP BY ALL),
k AS (SELECT conv_id, turn, sum(n)::BIGINT AS n_linked, first(origin ORDER BY depth, n DESC, origin DESC) AS reply_to FROM b GROUP BY conv_id, turn),
f AS (SELECT conv_id, turn, reply_to AS root, 1::BIGINT AS level FROM k
  UNION ALL SELECT f.conv_id, f.turn, k.reply_to, level + 1 FROM f JOIN k ON f.conv_id IS NOT DISTINCT FROM k.conv_id AND f.root = k.turn),
e AS (SELECT conv_id, turn, max(level) AS level, max_by(root, level) AS root FROM f GROUP BY conv_id, turn)
SELECT t.conv_id, t.turn, role, CASE WHEN quotes THEN content ELSE t END AS content,
  '<|' || role || '|>' || chr(10) || CASE WHEN quotes THEN content ELSE t END || '<|end|>' AS formatted,
  reply_to, coalesce(root, t.turn) AS thread, coalesce(level, 0) AS level, coalesce(n_quoted, 0) AS n_quoted, coalesce(max_depth, 0) AS max_depth, coalesce(n_linked, 0) AS n_linked
FROM t JOIN c USING (r) LEFT JOIN v USING (r) LEFT JOIN k ON t.conv_id IS NOT DISTINCT FROM k.conv_id AND t.turn = k.turn
LEFT JOIN e ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.turn = e.turn"""


ORACLE = _oracle()
