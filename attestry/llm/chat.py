"""Reply trees to chat training text.

Paths come from iterative self-joins by pointer doubling: after k rounds each node points 2**k replies up and knows the sum of
the scores below that, so that a chain of n replies takes log2(n) joins of narrow rows. Leaves are ranked by the sums of their paths
before any path is listed; only the chosen ones are then walked down from the longest jumps, and their texts joined once.
Each chosen path is formatted as one conversation whose control strings cannot be forged by a text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestry.llm.common import forget, grouped, map_rows, partitions, table, written

OPEN, SEP, CLOSE = "<|turn|>", "<|says|>", "<|end|>"
#: What a text may not contain as it stands, after its first character: markers of this template and of other common ones.
_TAIL = r"\|[A-Za-z0-9_]+\|>|/?s>|/?INST\]|</?SYS>>"
_ESCAPE = re.compile(rf"([<\[])(\\*)(?={_TAIL})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)(?={_TAIL})")


def escape(text: str) -> str:
    """Puts one more backslash after the first character of each control string, escaped ones included."""
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    """The inverse of escape."""
    return _UNESCAPE.sub(r"\1\2", text)


def format_turns(turns: Iterator[tuple[str, str]], learned: frozenset[str] = frozenset({"assistant"})) -> tuple[str, list[tuple[int, int]]]:
    """Text of a conversation and the code point spans under the loss mask: the texts of the learned roles."""
    parts: list[str] = []
    spans, at = [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{SEP}", escape(text)
        if role in learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns that format_turns() was given, read from its text alone."""
    out = []
    for piece in formatted.split(OPEN)[1:]:
        role, _, rest = piece.partition(SEP)
        out.append((unescape(role), unescape(rest.removesuffix(CLOSE))))
    return out



def same(a: str, b: str, *more: tuple[str, str]):
    """Condition: the trees a and b are the same, null included, and the other columns are equal."""
    found = F.col(a).eqNullSafe(F.col(b))
    for x, y in more:
        found &= F.col(x) == F.col(y)
    return found


def climbed(links: DataFrame) -> list[DataFrame]:
    """links (tree, node, parent, score), unique by (tree, node) -> after each round k, (tree, node, up, total, n): the node 2**k replies up, or
    null beyond the root, and the sum of the scores and the number of the nodes below it, the node included.

    A parent that isn't in the tree makes a root; null trees are a tree of their own. A cycle raises ValueError: a path can't be
    longer than there are nodes.
    """
    keys = links.select(F.col("tree").alias("b_tree"), F.col("node").alias("b_node"))
    first = links.join(keys, same("tree", "b_tree", ("parent", "b_node")), "left")
    rounds = [written(first.select("tree", "node", F.col("b_node").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("n")), "climb")]
    most = rounds[0].count()
    while rounds[-1].where("up is not null").head(1):
        if 1 << (len(rounds) - 1) > most:
            raise ValueError("the replies contain a cycle")
        now = rounds[-1]
        above = now.select(F.col("tree").alias("b_tree"), F.col("node").alias("b_node"), F.col("up").alias("b_up"), F.col("total").alias("b_total"), F.col("n").alias("b_n"))
        far = now.where("up is not null").join(above, same("tree", "b_tree", ("up", "b_node"))).select("tree", "node", F.col("b_up").alias("up"), (F.col("total") + F.col("b_total")).alias("total"), (F.col("n") + F.col("b_n")).alias("n"))
        rounds.append(written(now.where("up is null").unionByName(far), "climb"))
    return rounds


def leaves(rounds: list[DataFrame]) -> DataFrame:
    """(tree, leaf, path_score, n): the nodes that nothing replies to, with the sum of the scores and the nodes of their path to the root."""
    replied = rounds[0].where("up is not null").select(F.col("tree").alias("b_tree"), F.col("up").alias("b_node")).distinct()
    return rounds[-1].join(replied, same("tree", "b_tree", ("node", "b_node")), "left_anti").select("tree", F.col("node").alias("leaf"), F.col("total").alias("path_score"), "n")


def expanded(chosen: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """chosen (tree, leaf, ...) -> its columns with up and node: the nodes of each path, up replies above its leaf."""
    paths = chosen.withColumns({"up": F.lit(0).cast("long"), "node": F.col("leaf")})
    names = paths.columns
    for k in reversed(range(len(rounds) - 1)):
        step = rounds[k].where("up is not null").select(F.col("tree").alias("b_tree"), F.col("node").alias("b_node"), F.col("up").alias("above"))
        more = paths.join(step, same("tree", "b_tree", ("node", "b_node"))).withColumns({"up": F.col("up") + (1 << k), "node": F.col("above")})
        paths = paths.unionByName(more.select(*names))
        if k and k % 2 == 0:  # two steps of a union double the plan four times over
            paths = written(paths, "paths")
    return paths


def key_of(tree: str, name: str):
    """Column: a digest of a tree, which may be null, and a name in it."""
    return F.md5(F.concat_ws("\x1f", F.col(tree).isNull().cast("string"), F.coalesce(F.col(tree).cast("string"), F.lit("")), F.col(name).cast("string")))


def formatted(links: DataFrame, said: DataFrame, n_best: int, learned: tuple[str, ...]) -> DataFrame:
    """links (tree, node, parent, score, base) and said (tree, base, role, text, ...), base naming a node's text -> as formatted_conversations().

    said is read and shuffled once for the join with the chosen paths, and once more by path.
    """
    bases = written(links, "links")
    rounds = climbed(bases)
    order = Window.partitionBy("tree").orderBy(F.desc("path_score"), "leaf")
    chosen = leaves(rounds).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_best).select("tree", "leaf", "rank", "path_score")
    paths = expanded(chosen, rounds)
    named = bases.select(F.col("tree").alias("b_tree"), F.col("node").alias("b_node"), "base")
    places = written(paths.join(named, same("tree", "b_tree", ("node", "b_node"))).select("tree", "leaf", "rank", "path_score", "up", key_of("tree", "base").alias("key")), "places")
    forget(*rounds, bases)
    texts = said.withColumn("key", key_of("tree", "base")).groupBy("key").agg(F.min(F.struct(*[c for c in said.columns if c not in ("tree", "base")])).alias("x"))
    rows = places.join(texts, "key").select("tree", "leaf", "rank", "path_score", "up", "x.role", "x.text")
    rows = rows.repartition(partitions(rows.sparkSession), "tree", "leaf").sortWithinPartitions("tree", "leaf", F.desc("up"))
    kinds = dict(rows.dtypes)

    def run(found):
        for (tree, leaf, rank, score), turns in grouped(found, 4):
            count = 0

            def each(turns=turns):
                nonlocal count
                for turn in turns:
                    count += 1
                    yield turn[5], turn[6]

            text, spans = format_turns(each(), frozenset(learned))
            yield tree, leaf, rank, score, count, text, [{"from": a, "to": b} for a, b in spans]

    return map_rows(rows, run, f"tree {kinds['tree']}, leaf {kinds['leaf']}, rank int, score double, n_turns long, formatted string, loss_spans array<struct<from:long,to:long>>")


def formatted_conversations(messages: DataFrame, n_best: int = 1, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """messages (tree, node, parent, role, text, score) -> (tree, leaf, rank, score, n_turns, formatted, loss_spans).

    One row for each of the n_best root-to-leaf paths of a tree, by the sum of their scores, ties by the smaller leaf. Null
    roles and texts count as empty, null scores as zero, null trees as a tree; rows with a null node are dropped, as no reply can name them. Of
    rows that repeat (tree, node) the smallest (parent, role, MD5 of the text, score) is kept. A parent that isn't in the tree makes
    a root; a cycle raises ValueError. An empty table gives an empty one. Other columns of messages don't matter. A conversation is held
    whole by the task that formats it, as it is one row of the result.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = messages.where("node is not null").select("tree", "node", "parent", role.alias("role"), F.md5(text).alias("digest"), F.coalesce("score", F.lit(0.0)).alias("score"), text.alias("text"))
    links = rows.groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "digest", "score")).alias("x")).select("tree", "node", "x.parent", "x.score", F.col("node").alias("base"))
    return formatted(links, rows.withColumnRenamed("node", "base").select("tree", "base", "parent", "role", "digest", "score", "text"), n_best, learned)


def linear_conversations(conversations: DataFrame, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Rows (conv_id, turn, role, text) as formatted_conversations() with one path to a conversation: each row is a reply to the one before it.

    Rows lie by turn (null first), role and MD5 of the text, null being empty. Rows that repeat are turns of their own. Texts take no part in
    the ordering but by their digest, so that it shuffles narrow rows.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select(F.col("conv_id").alias("tree"), "turn", role.alias("role"), F.md5(text).alias("digest"), text.alias("text"))
    rows = rows.withColumn("base", F.md5(F.concat_ws("\x1f", F.coalesce(F.col("turn").cast("string"), F.lit("")), "digest", "role")))
    counted = rows.groupBy("tree", "turn", "role", "digest", "base").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    each = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    node = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "digest", "copy")).cast("long")
    links = each.select("tree", node.alias("node"), "base").select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "base")
    return formatted(links, rows.select("tree", "base", "role", "text"), 1, learned)


def digests(formatted: DataFrame) -> DataFrame:
    """(tree, formatted, loss_spans) -> what the formatted text says when it is read back; a row for each, none for an empty table. Texts aren't null."""

    def run(rows):
        for tree, text, spans in rows:
            turns = read_turns(text)
            said, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
            for role, what in turns:
                said.update(f"{role}\n{what}\n".encode())
            for span in spans:
                learned = unescape(text[span["from"] : span["to"]])
                chars += len(learned)
                loss.update(learned.encode())
            yield tree, len(turns), said.hexdigest(), chars, loss.hexdigest(), len(text)

    kind = dict(formatted.dtypes)["tree"]
    return map_rows(formatted.select("tree", "formatted", "loss_spans"), run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one of control strings, read back from their formatted texts."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", trap), (-1, 1, "assistant", trap)], said.schema)
    return digests(linear_conversations(said.unionByName(more)))


#: Each control string in a text gets one backslash; those of one text don't overlap.
ORACLE = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) as n
  from (
    select conv_id, turn, role, text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
  )
),
sized as (
  select *, len(role) + len(text) + len('<|turn|>') + len('<|says|>') + len('<|end|>')
    + len(regexp_extract_all(role || chr(0) || text, '[<\[]\\*(?:\|[A-Za-z0-9_]+\|>|/?s>|/?INST\]|</?SYS>>)')) as chars
  from said
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
  cast(coalesce(sum(len(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by n) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id
"""
