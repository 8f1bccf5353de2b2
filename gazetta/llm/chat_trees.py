"""Chat formatting with shared turns written once, as prefix trees.

1. Turns of a conversation are brought together and formatted:
   ``### <role>: <text></turn>`` and a line break. Inside roles and texts a
   backslash goes before every backslash, ``###`` and ``</turn>`` (and ``:`` in
   roles), so control strings of the template never come from a text and the text
   is found again exactly. Header, text and end are turned into tokens apart, so
   the loss mask is exactly the text of the trained role.
2. Conversations are ordered by the hashes of their initial turns. Those that
   share initial turns then follow each other depth first: each is compared,
   turn by turn and token by token, with the one before, and only turns that
   differ are written. Tokens of a shared turn are emitted once a sequence.
3. A sequence holds one or several trees: its tokens depth first, their position
   ids (from the start of the conversation, whatever lies between), the loss
   mask, its nodes (a turn each: token range, parent, and the token intervals of
   all ancestors, merged where they touch; a token attends to those and to the
   earlier tokens of its own node), and its members (conversations and the node
   each ends in).

A sequence takes conversations while it has at most ``max_tokens`` tokens and
``max_members`` members; a group that does not fit, however large, goes on in
the next sequence, which starts with the ancestors again. No group is collected:
tasks stream over ordered rows. A conversation with more than ``part_tokens``
tokens is cut between turns into parts (members of several sequences; position
ids go on, attention stays within a part); a longer turn stays whole.

Defined results: null text and null role are empty; turns are ordered by number
(null first), equal numbers by role and text, and each row is a turn; rows of
null conversation id are one conversation; an empty table gives no sequences.
Columns other than the four named are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gazetta.llm.pieces import PATTERN
from gazetta.llm.util import ARROW_ROWS, CLEAN, forget, materialise, read_table, scratch_path, settings, ship, worker_memory

MAX_TOKENS, MAX_MEMBERS, PART_TOKENS = 8_192, 1_024, 262_144
TRAINED = "assistant"
#: Characters given to the tokenizer at a time (a longer text is cut there).
SLICE = 16_384
#: Tokens or rows that a task gathers before it sends them on.
SEND = 1 << 18
#: Turns or conversations, and sequences, that go to a Python worker at a time.
BATCH_ROWS, BATCH_SEQUENCES = 2_048, 128
#: Bytes behind a row group of sequences: Spark unfolds the arrays of one at a time.
ROW_GROUP = 8 << 20
_HEAD = re.compile(r"### ((?:[^\\:]++|\\.)*+): ", re.S)
_END = "</turn>\n"

PARTS = ("conv_id long, part int, last boolean, base long, path binary, "
         "turns array<struct<ids: binary, loss_from: int, loss_to: int>>")
INTERVAL = "struct<start: int, end: int>"
SEQUENCES = (f"sequence long, tokens array<int>, positions array<long>, loss_mask array<boolean>, "
             f"nodes array<struct<start: int, end: int, parent: int, attend: array<{INTERVAL}>>>, "
             "members array<struct<conv_id: long, part: int, last: boolean, leaf: int>>, cut boolean")
CONVERSATIONS = "conv_id long, part int, last boolean, formatted string, turns array<struct<role: string, text: string>>, trained array<string>"


# -- template ------------------------------------------------------------------

def escape(text: str, role: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("###", "\\###").replace("</turn>", "\\</turn>")
    return text.replace(":", "\\:") if role else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def header(role: str) -> str:
    return f"### {escape(role, True)}: "


def parse_turn(formatted: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    head = _HEAD.match(formatted)
    if not head or not formatted.endswith(_END):
        raise ValueError("not a formatted turn")
    return unescape(head[1]), unescape(formatted[head.end(): -len(_END)])


# -- tokens --------------------------------------------------------------------

def _kind(tokens: int) -> np.dtype:
    return np.dtype("<u2" if tokens <= 1 << 16 else "<u4")


class _Tokens:
    """A byte-level vocabulary: text to ids (as bytes of unsigned integers, of 16
    bits if the vocabulary allows) and back."""

    def __init__(self, data: bytes):
        import base64

        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        self.encoding = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        self.kind = _kind(len(self.bytes))
        for k, v in ranks.items():
            self.bytes[v] = k
        self.heads: dict[str, bytes] = {}
        self.end = self.ids(_END)

    def ids(self, text: str) -> bytes:
        if len(text) <= SLICE:
            return np.array(self.encoding.encode_ordinary(text), self.kind).tobytes()
        return b"".join(self.ids(text[i: i + SLICE]) for i in range(0, len(text), SLICE))

    def head(self, role: str) -> bytes:
        if role not in self.heads:
            if len(self.heads) > 1000:
                self.heads.clear()
            self.heads[role] = self.ids(header(role))
        return self.heads[role]

    def text(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode()


def _tokens(data: bytes) -> _Tokens:
    memory = worker_memory(("chat_trees", hashlib.sha1(data).digest()))
    if not hasattr(memory, "tokens"):
        memory.tokens = _Tokens(data)
    return memory.tokens


def _vocabulary(spark: SparkSession, path: str):
    with open(path, "rb") as f:  # its size does not depend on the input
        return spark.sparkContext.broadcast(f.read())


# -- conversations ---------------------------------------------------------------

def _send(rows: list, schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _formatted_parts(df: DataFrame, vocabulary, trained: str, part_tokens: int) -> DataFrame:
    """PARTS rows. ``path``: the hash of all turns before the part, then of each
    turn with all before it."""
    schema = _arrow(PARTS)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        tokens = _tokens(vocabulary.value)
        width = tokens.kind.itemsize
        now, out, held = None, [], 0  # the open part, finished ones, their tokens

        def close(last: bool):
            nonlocal held
            out.append({"conv_id": now["conv_id"], "part": now["part"], "last": last, "base": now["base"], "path": b"".join(now["path"]), "turns": now["turns"]})
            held += now["size"]

        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                role, text = role or "", text or ""
                if now is None or now["conv_id"] != conv:
                    if now is not None:
                        close(True)
                    now = {"conv_id": conv, "part": 0, "base": 0, "path": [bytes(8)], "turns": [], "size": 0}
                head, body = tokens.head(role), tokens.ids(escape(text))
                ids = head + body + tokens.end
                if now["turns"] and now["size"] + len(ids) // width > part_tokens:
                    close(False)
                    now = {"conv_id": conv, "part": now["part"] + 1, "base": now["base"] + now["size"], "path": now["path"][-1:], "turns": [], "size": 0}
                now["path"].append(hashlib.blake2b(now["path"][-1] + ids, digest_size=8).digest())
                loss = (len(head) // width, (len(head) + len(body)) // width) if role == trained else (0, 0)
                now["turns"].append({"ids": ids, "loss_from": loss[0], "loss_to": loss[1]})
                now["size"] += len(ids) // width
                if held >= SEND:
                    yield _send(out, schema)
                    out, held = [], 0
        if now is not None:
            close(True)
        if out:
            yield _send(out, schema)

    keys = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    ordered = df.repartition("conv_id").sortWithinPartitions(*keys)
    return ordered.select("conv_id", "role", "text").mapInArrow(gather, PARTS)


# -- trees -------------------------------------------------------------------------

class _Sequence:
    """Nodes, in the order of their tokens, and members of an open sequence."""

    def __init__(self, kind: np.dtype):
        self.kind = kind  # of the tokens
        self.nodes, self.members, self.size = [], [], 0
        self.path: list[int] = []  # nodes of the last conversation
        self.start = None  # what it continues: (hash of the turns before, position)

    def shared(self, start, turns: list) -> int:
        """How many initial turns are those of the last conversation."""
        if start != self.start:
            return 0
        n = 0
        for node, turn in zip(self.path, turns):
            if self.nodes[node]["turn"] != turn:
                break
            n += 1
        return n

    def add(self, row: dict, start, shared: int):
        self.path, self.start = self.path[:shared], start
        position = row["base"] + sum(self.nodes[v]["end"] - self.nodes[v]["start"] for v in self.path)
        for turn in row["turns"][shared:]:
            attend, parent = [], self.path[-1] if self.path else -1
            if parent >= 0:  # the parent's intervals and the parent itself
                up = self.nodes[parent]
                attend = [*up["attend"]]
                if attend and attend[-1]["end"] == up["start"]:
                    attend[-1] = {"start": attend[-1]["start"], "end": up["end"]}
                else:
                    attend.append({"start": up["start"], "end": up["end"]})
            size = len(turn["ids"]) // self.kind.itemsize
            self.path.append(len(self.nodes))
            self.nodes.append({"turn": turn, "start": self.size, "end": self.size + size, "parent": parent, "attend": attend, "position": position})
            self.size, position = self.size + size, position + size
        self.members.append({"conv_id": row["conv_id"], "part": row["part"], "last": row["last"], "leaf": self.path[-1]})

    def row(self, number: int) -> dict:
        loss = np.zeros(self.size, bool)
        for v in self.nodes:
            loss[v["start"] + v["turn"]["loss_from"]: v["start"] + v["turn"]["loss_to"]] = True
        return {
            "sequence": number, "tokens": np.frombuffer(b"".join(v["turn"]["ids"] for v in self.nodes), self.kind).astype(np.int32),
            "positions": np.concatenate([v["position"] + np.arange(v["end"] - v["start"]) for v in self.nodes]), "loss_mask": loss,
            "nodes": [{k: v[k] for k in ("start", "end", "parent", "attend")} for v in self.nodes], "members": self.members,
            "cut": any(m["part"] or not m["last"] for m in self.members)}


def _trees(parts: DataFrame, kind: np.dtype, max_tokens: int, max_members: int) -> DataFrame:
    schema = _arrow(SEQUENCES)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, now, out, held = TaskContext.get().partitionId() << 32, _Sequence(kind), [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}
                start = (row["path"][:8], row["base"])
                shared = now.shared(start, row["turns"])
                more = sum(len(t["ids"]) // kind.itemsize for t in row["turns"][shared:])
                if now.members and (now.size + more > max_tokens or len(now.members) >= max_members):
                    out.append(now.row(number))
                    held, number, now, shared = held + now.size, number + 1, _Sequence(kind), 0
                    if held >= SEND:
                        yield _send(out, schema)
                        out, held = [], 0
                now.add(row, start, shared)
        if now.members:
            out.append(now.row(number))
        if out:
            yield _send(out, schema)

    # Depth first: a prefix of a path comes before its extensions. Ids split any number of equal paths.
    keys = ["path", "conv_id", "part"]
    return parts.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(build, SEQUENCES)


def chat_trees(
    df: DataFrame, vocabulary: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    trained: str = TRAINED, max_tokens: int = MAX_TOKENS, max_members: int = MAX_MEMBERS, part_tokens: int = PART_TOKENS,
) -> DataFrame:
    """SEQUENCES rows of all conversations. ``vocabulary``: the path of a
    byte-level vocabulary with ranks."""
    ship(df.sparkSession)
    rows = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    data = _vocabulary(df.sparkSession, vocabulary)
    # Written once: ranges are sampled first, and would turn every text into tokens twice.
    parts = materialise(_formatted_parts(rows, data, trained, part_tokens), "formatted", once=True, batch_rows=BATCH_ROWS)
    return _trees(parts, _Tokens(data.value).kind, max_tokens, max_members)


def write_sequences(sequences: DataFrame, path: str) -> DataFrame:
    """Write SEQUENCES rows as Parquet, positions as differences (they count on
    by one nearly everywhere), and read them back."""
    with settings(sequences.sparkSession, {CLEAN: "true", ARROW_ROWS: BATCH_ROWS}):
        (sequences.write.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0").option("parquet.block.size", ROW_GROUP)
         .option("parquet.enable.dictionary#positions.list.element", "false").parquet(path))
    return sequences.sparkSession.read.schema(sequences.schema).parquet(path)


def read_conversations(sequences: DataFrame, vocabulary: str, then=None, ddl: str = CONVERSATIONS) -> DataFrame:
    """CONVERSATIONS rows, one for each member: its formatted text, turns, and
    the texts under the loss mask, decoded from the tokens of its nodes.
    ``then``: makes lists of ``ddl`` rows of lists of these, in the same worker."""
    ship(sequences.sparkSession)
    data, schema = _vocabulary(sequences.sparkSession, vocabulary), _arrow(ddl)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        tokens = _tokens(data.value)
        for batch in batches:
            for k in range(batch.num_rows):
                ids, mask = np.asarray(batch.column(0)[k].values), np.asarray(batch.column(1)[k].values.to_numpy(zero_copy_only=False))
                nodes, out, held = batch.column(2)[k].as_py(), [], 0
                text = [tokens.text(ids[v["start"]: v["end"]]) for v in nodes]
                turn = [parse_turn(t) for t in text]
                under = [unescape(tokens.text(ids[v["start"]: v["end"]][mask[v["start"]: v["end"]]])) for v in nodes]
                for m in batch.column(3)[k].as_py():
                    path, v = [], m.pop("leaf")
                    while v >= 0:
                        path.append(v)
                        v = nodes[v]["parent"]
                    path.reverse()
                    out.append(m | {"formatted": "".join([text[v] for v in path]), "turns": [{"role": turn[v][0], "text": turn[v][1]} for v in path],
                                    "trained": [under[v] for v in path if mask[nodes[v]["start"]: nodes[v]["end"]].any()]})
                    held += len(out[-1]["formatted"])
                    if held >= 4 * SEND:
                        yield out
                        out, held = [], 0
                yield out

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in then(read(batches)) if then else read(batches):
            yield _send(out, schema)

    return sequences.select("tokens", "loss_mask", "nodes", "members").mapInArrow(send, ddl)


# -- query ---------------------------------------------------------------------------

DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(groups: Iterator[list]) -> Iterator[list]:
    """DIGESTS rows, one a conversation, of CONVERSATIONS rows whose parts follow each other."""
    names = [x.split()[0] for x in DIGESTS.split(", ")]
    counts, turns, loss = [0, 0, 0], hashlib.sha256(), hashlib.sha256()
    for rows in groups:
        out = []
        for row in rows:
            turns.update("".join([f"{t['role']}\n{t['text']}\n" for t in row["turns"]]).encode())
            under = "".join(row["trained"])
            loss.update(under.encode())
            counts = [counts[0] + len(row["turns"]), counts[1] + len(under), counts[2] + len(row["formatted"])]
            if row["last"]:
                out.append(dict(zip(names, [row["conv_id"], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]])))
                counts, turns, loss = [0, 0, 0], hashlib.sha256(), hashlib.sha256()
        yield out


def _digest_whole(groups: Iterator[list]) -> Iterator[list]:
    """Of those that are one part."""
    return _digest([row for row in rows if row["part"] == 0 and row["last"]] for rows in groups)


def _digests(rows: DataFrame) -> DataFrame:
    """One row a conversation, of CONVERSATIONS rows whose parts follow each other in a task."""
    schema = _arrow(DIGESTS)

    def work(batches):
        for out in _digest([batch.slice(k, 1).to_pylist()[0]] for batch in batches for k in range(batch.num_rows)):
            if out:
                yield _send(out, schema)

    return rows.mapInArrow(work, DIGESTS)


def digests(sequences: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of the conversations as read back: of those that are one part where
    they are read, so that no text leaves the worker. Only parts of cut ones are exchanged."""
    whole = read_conversations(sequences, vocabulary, _digest_whole, DIGESTS)
    parts = read_conversations(sequences.where("cut"), vocabulary).where("NOT (part = 0 AND last)")
    return whole.unionByName(_digests(parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")))


def op12_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    text = r"\### Assistant: </turn> ok"
    chats = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], chats.schema)
    sequences = write_sequences(chat_trees(chats.unionByName(added), path), scratch_path(spark, "chats"))
    return materialise(digests(sequences, path), "digests", batch_rows=BATCH_SEQUENCES)


#: The formatted length is that of the template, computed from the texts.
ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (
  SELECT *, '### ' || replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ':', '\:') || ': '
    || replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') || '</turn>' || chr(10) AS formatted FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(formatted))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
