"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share those turns' nodes.  Sorting
conversations by their paths of node ids is a depth-first walk of the tree; the first
conversation of that order that reaches a node emits it, so shared tokens stand once.
Every node carries its token interval in the emitted order, the position of its first
token along its path, and the intervals of its ancestors, which are all it may attend to.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cribble.llm.common import stage

# -- fixed values: the control strings of the template.
OPEN, CLOSE, ASK, END_ASK = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = re.compile("|".join(map(re.escape, ("\\", OPEN, CLOSE, ASK, END_ASK))))
ESCAPED = re.compile(r"\\(.)", re.S)
TURN = re.compile(r"<s>(\[INST\] )?([^\n]*)\n(.*?)( \[/INST\])?</s>", re.S)


def escape(text: str) -> str:
    """A backslash goes after the first character of every control string and before every backslash."""
    return CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """(formatted turn, start and end of the loss mask in it).  Only an assistant's text is under the mask."""
    body = escape(text)
    if role == "assistant":
        head = f"{OPEN}{escape_role(role)}\n"
        return f"{head}{body}{CLOSE}", len(head), len(head) + len(body)
    return f"{OPEN}{ASK} {escape_role(role)}\n{body} {END_ASK}{CLOSE}", 0, 0


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back from formatted turns."""
    return [(unescape_role(m[2]), unescape(m[3])) for m in TURN.finditer(formatted)]


def _chains(turns: DataFrame) -> DataFrame:
    """One row per conversation and turn: node id (hash of the whole prefix) and formatted turn."""
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        F.coalesce(F.col("turn"), F.lit(-(1 << 62))).alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                ids, roles, texts, starts, ends, convs = [], [], [], [], [], []
                part = batch.slice(lo, 64)
                for conv, rows in zip(part.column("conv_id").to_pylist(), part.column("turns").to_pylist()):
                    prefix, path = b"", []
                    for r in rows:
                        text, s, e = format_turn(r["role"], r["text"])
                        prefix = hashlib.blake2b(prefix + text.encode(), digest_size=16).digest()
                        path.append(prefix)
                        roles.append(r["role"])
                        texts.append(text)
                        starts.append(s)
                        ends.append(e)
                    ids.append(path)
                    convs.append(conv)
                out = pa.RecordBatch.from_arrays(
                    [pa.array(convs, pa.int64()), pa.array(ids, pa.list_(pa.binary())),
                     _lists(ids, texts, pa.string()), _lists(ids, starts, pa.int64()), _lists(ids, ends, pa.int64())],
                    names=["conv_id", "path", "texts", "loss_start", "loss_end"])
                yield out

    return ordered.mapInArrow(run, "conv_id long, path array<binary>, texts array<string>, "
                                   "loss_start array<long>, loss_end array<long>")


def _lists(shape: list[list], values: list, kind: pa.DataType) -> pa.Array:
    offsets = [0]
    for s in shape:
        offsets.append(offsets[-1] + len(s))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _ranked(convs: DataFrame) -> DataFrame:
    """``rank`` numbers conversations in the order of their paths: a range sort, numbered in each
    partition and shifted by the sizes of the partitions before (one row per partition)."""
    parts = max(1, convs.rdd.getNumPartitions())
    sort = convs.withColumn("_sort", F.concat_ws("", F.transform("path", lambda b: F.hex(b))))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * b.num_rows, pa.int32()), pa.array(range(n, n + b.num_rows), pa.int64())],
                names=[*b.schema.names, "part", "at"])
            n += b.num_rows

    slim = sort.select("conv_id", "path", "_sort").repartitionByRange(parts, "_sort", "conv_id")
    local = stage(slim.sortWithinPartitions("_sort", "conv_id").drop("_sort").mapInArrow(
        number, "conv_id long, path array<binary>, part int, at long"), "conversation-order")
    return local


def prefix_tree(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, paths) of all conversations.

    nodes: node_id, parent_id, depth, text (the formatted turn), loss_start, loss_end (the
    loss mask inside it, in code points), token_start, token_end (its interval in the
    emitted depth-first stream), position (of its first token along its path) and
    ancestors (the token intervals it attends to, from the root down).  Tokens are code
    points.  paths: conv_id and the node ids of its turns in order.

    Null text and null role are empty, a null turn number comes first, equal turn
    numbers are ordered by role and text and all kept (repeated rows too), a null conv_id
    is one conversation; other columns are ignored; no rows give no nodes.  A node shared
    by most conversations is reduced by map-side minima; only one row of it is emitted.
    """
    convs = stage(_chains(turns.select("conv_id", "turn", "role", "text")), "conversations")
    order = _ranked(convs)
    sizes = order.groupBy("part").agg(F.count("*").alias("n"))
    shift = {r["part"]: r["n"] for r in sizes.collect()}  # one number per partition of the sort
    total, base = 0, {}
    for p in sorted(shift):
        base[p], total = total, total + shift[p]
    offset = F.create_map(*[F.lit(x) for p in sorted(base) for x in (p, base[p])]) if base else None
    rank = (F.element_at(offset, F.col("part")) + F.col("at")) if base else F.col("at")
    ranks = order.select(F.col("conv_id").alias("_c"), rank.cast("long").alias("rank"))
    # conversations with equal paths share all nodes, whichever of them comes first
    full = convs.join(ranks, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    at = F.arrays_zip(F.col("path").alias("id"), F.col("texts").alias("text"), F.col("loss_start").alias("ls"),
                      F.col("loss_end").alias("le"))
    steps = full.select("rank", "path", F.posexplode(at).alias("depth", "s")).select(
        "rank", "depth", F.col("s.id").alias("node_id"),
        F.when(F.col("depth") > 0, F.element_at("path", F.greatest(F.col("depth"), F.lit(1)))).alias("parent_id"),
        F.col("s.text").alias("text"), F.col("s.ls").alias("loss_start"), F.col("s.le").alias("loss_end"))
    nodes = stage(steps.groupBy("node_id").agg(
        F.min("rank").alias("owner"), F.first("depth").alias("depth"), F.first("parent_id").alias("parent_id"),
        F.first("text").alias("text"), F.first("loss_start").alias("loss_start"),
        F.first("loss_end").alias("loss_end")).withColumn("tokens", F.length("text").cast("long")), "tree-nodes")
    # tokens emitted by every owner, summed in the order of the ranks: sort, sum per partition, shift
    owned = nodes.groupBy("owner").agg(F.sum("tokens").alias("tokens"))
    starts = running_total(owned, "owner", "tokens")
    mine = F.array_sort(F.collect_list(F.struct("depth", "node_id", "tokens")))
    inside = (nodes.groupBy("owner").agg(mine.alias("own")).join(starts, "owner")
              .select("before", F.posexplode("own").alias("i", "x"), "own")
              .select(F.col("x.node_id").alias("node_id"),
                      (F.col("before") + F.aggregate(F.slice("own", 1, F.col("i")), F.lit(0).cast("long"),
                                                     lambda a, y: a + y["tokens"])).alias("token_start")))
    placed = stage(nodes.join(inside, "node_id").withColumn("token_end", F.col("token_start") + F.col("tokens"))
                   .drop("tokens"), "tree-intervals")
    # ancestors of a node: the turns before it in its owner's path
    owners = full.select(F.col("rank").alias("owner"), "path")
    up = (placed.select("node_id", "owner", "depth").where("depth > 0").join(owners, "owner")
          .select("node_id", F.posexplode(F.slice("path", 1, F.col("depth"))).alias("i", "up"))
          .join(placed.select(F.col("node_id").alias("up"), "token_start", "token_end"), "up")
          .groupBy("node_id").agg(F.array_sort(F.collect_list(F.struct("i", "token_start", "token_end"))).alias("a")))
    bare = F.transform("a", lambda x: F.struct(x["token_start"].alias("start"), x["token_end"].alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    tree = (placed.join(up, "node_id", "left").withColumn("ancestors", F.coalesce(bare, none)).drop("a")
            .withColumn("position", F.aggregate("ancestors", F.lit(0).cast("long"),
                                                lambda s, x: s + x["end"] - x["start"])))
    return (tree.select("node_id", "parent_id", "depth", "text", "loss_start", "loss_end", "token_start", "token_end",
                        "position", "ancestors"), convs.select("conv_id", "path"))


def running_total(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, before): sum of ``value`` over the smaller keys, without a single-task window."""
    parts = max(1, df.rdd.getNumPartitions())
    names = [key, value]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for b in batches:
            before = []
            for v in b.column(1).to_pylist():
                before.append(total)
                total += v
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([part] * len(before), pa.int32()),
                                              pa.array(before, pa.int64())], names=[*names, "part", "inside"])

    local = stage(df.select(*names).repartitionByRange(parts, key).sortWithinPartitions(key).mapInArrow(
        add, f"{key} long, {value} long, part int, inside long"), "running-total")
    sums = {r["part"]: r["s"] for r in local.groupBy("part").agg(F.sum(value).alias("s")).collect()}
    base, total = {}, 0
    for p in sorted(sums):
        base[p], total = total, total + sums[p]
    if not base:
        return local.select(key, F.col("inside").alias("before"))
    shift = F.create_map(*[F.lit(x) for p in sorted(base) for x in (p, base[p])])
    return local.select(key, (F.col("inside") + F.element_at(shift, F.col("part"))).cast("long").alias("before"))


def render(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Per conversation, read back from the emitted stream: conv_id and its segments in order, each
    (i, text, loss_start, loss_end).

    Only the last node of a conversation is looked up by its id; what stands before it are the token intervals it
    attends to, so the conversation is what a model would see through the ancestor mask.
    """
    last = paths.select("conv_id", F.element_at("path", -1).alias("node_id"))
    own = F.struct(F.col("token_start").alias("start"), F.col("token_end").alias("end"))
    spans = (last.join(nodes.select("node_id", F.concat("ancestors", F.array(own)).alias("seen")), "node_id")
             .select("conv_id", F.posexplode("seen").alias("i", "span"))
             .select("conv_id", "i", F.col("span.start").alias("token_start"), F.col("span.end").alias("token_end")))
    stream = nodes.select("token_start", "token_end", "text", "loss_start", "loss_end")
    seg = F.struct("i", "text", "loss_start", "loss_end")
    return (spans.join(stream, ["token_start", "token_end"])
            .groupBy("conv_id").agg(F.array_sort(F.collect_list(seg)).alias("segments")))


def digests(rendered: DataFrame) -> DataFrame:
    """Digests of what a reader of the formatted output sees (turns parsed and unescaped)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for conv, segs in zip(b.column("conv_id").to_pylist(), b.column("segments").to_pylist()):
                turns = [t for s in segs for t in parse(s["text"])]
                loss = "".join(unescape(s["text"][s["loss_start"]:s["loss_end"]]) for s in segs)
                sha = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                rows.append((conv, len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                             sum(len(s["text"]) for s in segs)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[
                "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return rendered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                    "loss_sha256 string, formatted_chars long")
