"""Chat formatting in prefix trees: turns that conversations share are emitted once.

A node is a turn together with all turns before it, named by a hash of them. The distinct
leaves, sorted by the nodes on their paths, are a depth-first order; a node is emitted
with the first leaf below it. Streams are cut into shards by ranges of paths, so that a
tree of any size is spread out. A node has the place of its tokens in its shard's stream,
the position id of its first token (the tokens of all its ancestors come before), and the
intervals of its ancestors, which with its own earlier tokens are all that it may attend
to. Conversations point to their last node.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from decreta.llm.batches import column, record
from decreta.llm.encoding import encoder
from decreta.session import staged

# The marks of a turn, and the control strings that texts must not hold:
# those marks and <s>, </s>, [INST], [/INST].
START, MIDDLE, STOP = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED_ROLE = "assistant"
_CONTROL = re.compile(r"([<\[])(\\*)(?=/?s>|/?INST\]|\|)")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=/?s>|/?INST\]|\|)")
_TURN = re.compile(re.escape(START) + "(.*?)" + MIDDLE + "(.*?)" + re.escape(STOP), re.S)
ROWS = 256
TURN = ("conv_id long, place int, node binary, role string, ids array<int>, loss_start int, loss_end int, n_tokens int")
INTERVAL = "struct<shard: int, start: long, end: long>"


def escape(text: str) -> str:
    """One more backslash inside each control string, also in those that have some."""
    return _CONTROL.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_back(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def parse(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation."""
    return [(_role_back(role), unescape(body)) for role, body in _TURN.findall(text)]


def _turns(rows: DataFrame, tokenizer: str) -> DataFrame:
    """Every turn of every conversation with its node and tokens: TURN."""
    out = to_arrow_schema(StructType.fromDDL(TURN))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                conv, place, node, roles, texts = [], [], [], [], []
                for conv_id, turns in zip(column(part, "conv_id").to_pylist(), column(part, "turns").to_pylist()):
                    above = b""
                    for i, t in enumerate(turns):
                        role, text = t["role"] or "", t["text"] or ""
                        name = role.encode()
                        above = hashlib.sha256(b"%b%d:%b%b" % (above, len(name), name, text.encode())).digest()[:16]
                        conv.append(conv_id)
                        place.append(i)
                        node.append(above)
                        roles.append(role)
                        texts += [START + _role(role) + MIDDLE, escape(text), STOP]
                ids, counts = encoder(tokenizer).encode(texts)
                counts = counts.reshape(-1, 3)
                total = counts.sum(axis=1)
                learned = np.array([r == LEARNED_ROLE for r in roles], bool)
                offsets = pa.array(np.concatenate([[0], np.cumsum(total)]), pa.int32())
                yield record({
                    "conv_id": conv, "place": place, "node": node, "role": roles, "n_tokens": total,
                    "ids": pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))),
                    "loss_start": counts[:, 0], "loss_end": counts[:, 0] + np.where(learned, counts[:, 1], 0)}, out)

    order = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    grouped = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").groupBy("conv_id").agg(order.alias("turns"))
    return grouped.mapInArrow(run, TURN)


def _common(a: list, b: list) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def _walk(shard: int, leaves: list[tuple], above: list[tuple]):
    """For each leaf in order: path, lengths, first new depth, and the interval of each
    node on the path. ``above``: intervals of the nodes that the shard before has emitted
    of the first path."""
    last, stack, end = None, above, 0
    for path, lengths in leaves:
        keep = len(above) if last is None else _common(last, path)
        stack = stack[:keep]
        for n in lengths[keep:]:
            stack = [*stack, (shard, end, end + n)]
            end += n
        last = path
        yield path, lengths, keep, stack


def _leaves(table: pa.Table) -> list[tuple]:
    return sorted(zip(table.column("path").to_pylist(), table.column("lengths").to_pylist()))


def _borders(at: DataFrame) -> dict[int, list[tuple]]:
    """For each shard the intervals of the nodes on its first path that earlier shards
    emit. One or two paths of each shard come to the driver, which the number of shards
    bounds."""
    def paths(key, table):
        rows = _leaves(table)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "first": pa.array([rows[0][0]], pa.list_(pa.binary())), "last": pa.array([rows[-1][0]], pa.list_(pa.binary()))})

    found = sorted(at.groupBy("shard").applyInArrow(paths, "shard int, first array<binary>, last array<binary>").collect(), key=lambda r: r["shard"])
    shared = {b["shard"]: _common(a["last"], b["first"]) for a, b in zip(found, found[1:])}

    def stacks(key, table):
        shard = key[0].as_py()
        *_, (_, _, _, stack) = _walk(shard, _leaves(table), [(-1, 0, 0)] * shared.get(shard, 0))
        return pa.table({"shard": pa.array([shard], pa.int32()), **{c: pa.array([[x[i] for x in stack]], t) for i, (c, t) in enumerate(
            (("of", pa.list_(pa.int32())), ("start", pa.list_(pa.int64())), ("end", pa.list_(pa.int64()))))}})

    ends = at.groupBy("shard").applyInArrow(stacks, "shard int, of array<int>, start array<long>, end array<long>").collect()
    above, last = {}, []
    for r in sorted(ends, key=lambda r: r["shard"]):
        above[r["shard"]] = last[:shared.get(r["shard"], 0)]
        last = [x if x[0] >= 0 else above[r["shard"]][d] for d, x in enumerate(zip(r["of"], r["start"], r["end"]))]
    return above


def chat_trees(rows: DataFrame, tokenizer: str) -> tuple[DataFrame, DataFrame]:
    """Streams and members of the conversations in ``rows`` (``conv_id, turn, role, text``).

    Streams: one row per node, ``shard, start, end`` (its tokens in the shard's stream, in
    depth-first order), ``node, depth, position`` (position id of the first token),
    ``ancestors`` (intervals that it may attend to, from the root down), ``role, ids,
    loss_start, loss_end`` (tokens under the loss mask, within the node). Members:
    ``conv_id, leaf``, the last node of each conversation.

    Rows are ordered by turn, ties by role and text; repeated rows are turns of their own.
    Null roles and texts count as empty. Rows without a conv_id are one conversation.
    """
    spark = rows.sparkSession
    turns = staged(_turns(rows, tokenizer), "turns")
    nodes = turns.groupBy("node").agg(*(F.first(c).alias(c) for c in ("role", "ids", "loss_start", "loss_end")))
    paths = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "node", "n_tokens"))).alias("t")).select(
        "conv_id", F.col("t.node").alias("path"), F.col("t.n_tokens").alias("lengths"), F.element_at("t.node", -1).alias("leaf"))
    paths = staged(paths, "paths")
    members = paths.select("conv_id", "leaf")
    leaves = paths.groupBy("leaf").agg(F.first("path").alias("path"), F.first("lengths").alias("lengths"))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The order is written down once, so that all passes over the shards agree.
    at = staged(leaves.repartitionByRange(shards, "path").select(F.spark_partition_id().alias("shard"), "path", "lengths"), "leaves")
    above = _borders(at)
    schema = f"shard int, start long, end long, node binary, depth int, position long, ancestors array<{INTERVAL}>"
    out = to_arrow_schema(StructType.fromDDL(schema))

    def emit(key, table):
        shard, made = key[0].as_py(), []
        for path, lengths, keep, stack in _walk(shard, _leaves(table), above[shard]):
            for depth in range(keep, len(path)):
                made.append((*stack[depth], path[depth], depth, sum(lengths[:depth]), [dict(zip(("shard", "start", "end"), x)) for x in stack[:depth]]))
        return pa.Table.from_batches([record({c: [m[i] for m in made] for i, c in enumerate(out.names)}, out)])

    emitted = at.groupBy("shard").applyInArrow(emit, schema)
    return staged(emitted.join(nodes, "node"), "streams"), members


def read_conversations(streams: DataFrame, members: DataFrame, tokenizer: str) -> DataFrame:
    """Every conversation read back from the streams, by its leaf's intervals.

    ``conv_id, n_turns, turns_sha256`` (of role, line feed, text, line feed per turn),
    ``loss_chars, loss_sha256`` (all text under the loss mask, unescaped, nothing between),
    ``formatted_chars`` (of the formatted conversation), all in code points.
    """
    wanted = members.select(F.col("leaf").alias("node")).distinct()
    whole = F.concat("ancestors", F.array(F.struct("shard", "start", "end")))
    parts = streams.join(wanted, "node").select(F.col("node").alias("leaf"), F.explode(whole).alias("x")).select("leaf", F.col("x.shard").alias("shard"), F.col("x.start").alias("start"))
    tokens = streams.select("shard", "start", F.struct("position", "ids", "loss_start", "loss_end").alias("part"))
    leaves = parts.join(tokens, ["shard", "start"]).groupBy("leaf").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    schema = "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        decode = lambda ids: encoder(tokenizer).tokenizer.decode(ids, skip_special_tokens=False)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part, made = batch.slice(at, ROWS), []
                for leaf, parts_ in zip(column(part, "leaf").to_pylist(), column(part, "parts").to_pylist()):
                    text = decode([i for p in parts_ for i in p["ids"]])
                    turns = parse(text)
                    learned = "".join(unescape(decode(p["ids"][p["loss_start"]:p["loss_end"]])) for p in parts_ if p["loss_end"] > p["loss_start"])
                    digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                    made.append((leaf, len(turns), digest, len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text)))
                yield record({c: [m[i] for m in made] for i, c in enumerate(out.names)}, out)

    digests = leaves.mapInArrow(run, schema)
    return members.join(digests, "leaf").drop("leaf")
