"""Chat formatting into prefix trees.

Conversations that share their first turns share a path of a tree whose nodes are turns. The formatted tokens of a
shared turn are emitted once, depth first; every node carries its first position id (as if its path stood alone)
and the intervals of the stream that its tokens may attend to, its ancestors.

A conversation's *path* is the chain of digests of its leading turns, so sorting by path is depth-first order. A
range sort by path deals distinct conversations out; each sorted partition is read as a stream that keeps the
current path on a stack and emits only the turns that differ from the previous conversation. Streams are cut into
shards of about ``shard_tokens``, and a shard (or a partition) starts by emitting its ancestors again, so neither a
first turn nor a conversation shared by a third of all rows meets in one task. Equal conversations are one path;
which conversations end there is a table (conv_id, path) that is only joined.

Turns are ordered by (turn, role, text). Null roles and texts count as empty, a null conversation id is a
conversation of its own id, repeated rows are repeated turns, other columns are not read, an empty table gives an
empty result. A single conversation is formatted whole in one task, however long it is.

Template: ``<|im_start|>role \\n text <|im_end|> \\n``; the two markers are ids of their own behind the vocabulary.
Texts escape ``\\`` and ``<|`` with a backslash, so no control string survives in them and the escape is reversible.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.byte_bpe import byte_bpe
from daymart.llm.common import batches, materialize

START, END = "<|im_start|>", "<|im_end|>"
NODES = ("shard long, node int, parent int, path binary, role string, tokens array<int>, loss_from int, loss_to int, "
         "position long, offset long, attends array<struct<first:long,last:long>>, is_end boolean")
_INTERVAL = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_NODES = pa.schema([("shard", pa.int64()), ("node", pa.int32()), ("parent", pa.int32()), ("path", pa.binary()),
                    ("role", pa.string()), ("tokens", pa.list_(pa.int32())), ("loss_from", pa.int32()),
                    ("loss_to", pa.int32()), ("position", pa.int64()), ("offset", pa.int64()),
                    ("attends", _INTERVAL), ("is_end", pa.bool_())])
READ = "path binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
DIGEST = 16
_HEAD = re.compile(r"((?:\\.|[^\\\n])*)\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


def chain(turns) -> bytes:
    """Digests of the leading turns, one behind another: a prefix of turns is a prefix of the chain."""
    at, out = b"", []
    for role, text in turns:
        role = role.encode("utf-8", "surrogatepass")
        at = hashlib.blake2b(at + len(role).to_bytes(8, "big") + role + text.encode("utf-8", "surrogatepass"),
                             digest_size=DIGEST).digest()
        out.append(at)
    return b"".join(out)


class Formatter:
    """Tokens of turns and back; the two markers get the ids behind the vocabulary's."""

    def __init__(self, vocabulary: str):
        self.bpe = byte_bpe(vocabulary)
        self.start = self.bpe.bpe.n_vocab
        self.end = self.start + 1
        self.markers = {self.start: START, self.end: END}

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """(tokens, first and last+1 token of the text)."""
        head = [self.start, *self.bpe.plain(escape_role(role) + "\n")]
        body = self.bpe.plain(escape(text))
        return head + body + [self.end, *self.bpe.plain("\n")], len(head), len(head) + len(body)

    def text(self, tokens) -> str:
        out, run = [], []
        for t in tokens:
            if t in self.markers:
                out += [self.bpe.bpe.decode_bytes(run).decode("utf-8"), self.markers[t]]
                run = []
            else:
                run.append(t)
        out.append(self.bpe.bpe.decode_bytes(run).decode("utf-8"))
        return "".join(out)


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns that a formatted conversation holds."""
    turns = []
    for part in formatted.split(START)[1:]:
        body = part[:part.index(END)]
        head = _HEAD.match(body)
        turns.append((unescape(head[1]), unescape(body[head.end():])))
    return turns


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, path, turns): one row per conversation."""
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    made = rows.select(rows["conv_id"].cast("long").alias("conv_id"), rows["turn"].cast("long").alias("turn"),
                       rows["role"], rows["text"]) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns")) \
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("turns"))
    path = F.pandas_udf(lambda s: pd.Series([chain((t["role"], t["text"]) for t in ts) for ts in s]), "binary")
    return made.select("conv_id", "turns", path("turns").alias("path"))


def prefix_tree(distinct: DataFrame, vocabulary: str, shard_tokens: int = 65_536) -> DataFrame:
    """Shards of depth-first nodes from distinct conversations (path, turns)."""
    order = distinct.repartitionByRange("path").sortWithinPartitions("path")

    def nodes(found):
        form = Formatter(vocabulary)
        shard, fill, count = TaskContext.get().partitionId() << 32, 0, 0
        stack: list[tuple] = []  # (digest, node, first, last, position behind) of the current path
        for batch in found:
            for path, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                digests = [path[i:i + DIGEST] for i in range(0, len(path), DIGEST)]
                if fill >= shard_tokens:
                    shard, fill, count, stack = shard + 1, 0, 0, []
                same = 0
                while same < min(len(stack), len(digests) - 1) and stack[same][0] == digests[same]:
                    same += 1
                del stack[same:]
                for k in range(same, len(turns)):
                    tokens, a, b = form.turn(turns[k]["role"], turns[k]["text"])
                    position = stack[-1][4] if stack else 0
                    yield (shard, count, stack[-1][1] if stack else -1, path[:(k + 1) * DIGEST], turns[k]["role"],
                           tokens, a, b, position, fill, [{"first": s[2], "last": s[3]} for s in stack],
                           k == len(turns) - 1)
                    stack.append((digests[k], count, fill, fill + len(tokens), position + len(tokens)))
                    fill, count = fill + len(tokens), count + 1

    def run(found):
        yield from batches(nodes(found), _NODES, 1024)

    return order.select("path", "turns").mapInArrow(run, NODES)


def read_back(nodes: DataFrame, vocabulary: str) -> DataFrame:
    """One row per path that ends a conversation, from the emitted tokens, masks and intervals alone."""

    def shard(found: pd.DataFrame) -> pd.DataFrame:
        form = Formatter(vocabulary)
        found = found.sort_values("node")
        stream = [t for tokens in found["tokens"] for t in tokens]
        masked = {}
        for offset, a, b, role in zip(found["offset"], found["loss_from"], found["loss_to"], found["role"]):
            if role == "assistant":
                masked[offset] = (offset + a, offset + b)
        out = []
        for path, offset, position, tokens, attends, is_end in zip(*(found[c] for c in (
                "path", "offset", "position", "tokens", "attends", "is_end"))):
            if not is_end:
                continue
            spans = [(i["first"], i["last"]) for i in attends] + [(offset, offset + len(tokens))]
            if position != sum(b - a for a, b in spans[:-1]):
                raise ValueError("position ids do not follow the ancestors")
            formatted = form.text(t for a, b in spans for t in stream[a:b])
            turns = turns_of(formatted)
            said = "".join(f"{role}\n{text}\n" for role, text in turns)
            loss = "".join(unescape(form.text(stream[a:b])) for a, b in (masked[s[0]] for s in spans
                                                                         if s[0] in masked))
            out.append((path, len(turns), hashlib.sha256(said.encode("utf-8", "surrogatepass")).hexdigest(),
                        len(loss), hashlib.sha256(loss.encode("utf-8", "surrogatepass")).hexdigest(),
                        len(formatted)))
        return pd.DataFrame(out, columns=["path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                          "formatted_chars"])

    return nodes.groupBy("shard").applyInPandas(shard, READ)


def format_chats(rows: DataFrame, vocabulary: str, shard_tokens: int = 65_536) -> tuple[DataFrame, DataFrame]:
    """(nodes, members): the written prefix trees, and the path at which each conversation ends."""
    convs = materialize(conversations(rows), "chat-conversations")
    distinct = convs.groupBy("path").agg(F.first("turns").alias("turns"))  # equal within a path
    return materialize(prefix_tree(distinct, vocabulary, shard_tokens), "chat-nodes"), convs.select("conv_id", "path")
