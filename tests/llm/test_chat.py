"""Prefix trees of conversations: exact round trips, sharing, attention."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gazetta.llm import chat_trees as C
from gazetta.llm.util import ARROW_ROWS, materialise

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = ["", None, "hi", r"\### Assistant: </turn> ok", "###", "</turn>\n### user: x", "\\", "\\\\</turn>", "日本語 😀", "<|endoftext|>", "a" * 40_000, "lines\n\n\r\n"]


def conversations(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(60):
        turns = [("system", "be kind"), ("user", rng.choice(["a", "b"]))][: rng.randint(0, 2)]
        turns += [(rng.choice(["user", "assistant", "to:ol", None]), rng.choice(TEXTS)) for _ in range(rng.randint(1, 6))]
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    rows += [(c, k, "assistant" if k % 2 else "user", f"turn {k % 5}") for c in range(100, 140) for k in range(4)]  # copies
    rows += [(None, 1, "user", "no id"), (7, None, "user", "no number"), (7, 0, "user", "again 0")]
    rows += [(500, k, "assistant", f"long {k} " + "w " * 30) for k in range(80)]
    return rows


def frame(spark, rows):
    data = [(*r, "x", 1) for r in rows]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, part string, tokens int").repartition(5)


def grouped(rows):
    out = {}
    for c, k, role, text in rows:
        out.setdefault(c, []).append((k is not None, k or 0, role is not None, role or "", text is not None, text or ""))
    return {c: [(t[3], t[5]) for t in sorted(v)] for c, v in out.items()}


@pytest.mark.parametrize("limits", [{}, {"max_tokens": 300, "max_members": 7, "part_tokens": 200}])
def test_round_trip(spark, limits):
    rows = conversations()
    sequences = C.chat_trees(frame(spark, rows), PATH, **limits).cache()
    back = {}
    for r in C.read_conversations(sequences, PATH).orderBy("part").collect():
        back.setdefault(r["conv_id"], []).append(r)
    expected = grouped(rows)
    assert back.keys() == expected.keys()
    for c, parts in back.items():
        assert [p["part"] for p in parts] == list(range(len(parts))) and [p["last"] for p in parts] == [False] * (len(parts) - 1) + [True]
        assert [tuple(t) for p in parts for t in p["turns"]] == expected[c]
        assert "".join(p["formatted"] for p in parts) == "".join(C.header(a) + C.escape(b) + "</turn>\n" for a, b in expected[c])
        assert "".join(t for p in parts for t in p["trained"]) == "".join(b for a, b in expected[c] if a == "assistant")
    assert any(len(p) > 1 for p in back.values()) == bool(limits)
    for r in sequences.collect():
        assert len(r["tokens"]) == len(r["positions"]) == len(r["loss_mask"])
        assert len(r["members"]) <= limits.get("max_members", C.MAX_MEMBERS)
        for v in r["nodes"]:
            # Ancestors, outermost first; positions count on from theirs.
            up, p = [], v["parent"]
            while p >= 0:
                up.insert(0, r["nodes"][p])
                p = r["nodes"][p]["parent"]
            seen = [t for a in v["attend"] for t in range(a["start"], a["end"])]
            assert seen == [t for a in up for t in range(a["start"], a["end"])]
            assert all(a["end"] < b["start"] for a, b in zip(v["attend"], v["attend"][1:]))
            own = r["positions"][v["start"]: v["end"]]
            assert own == list(range(own[0], own[0] + len(own)))
            if up:
                assert own[0] == r["positions"][up[-1]["end"] - 1] + 1
    sequences.unpersist()


def test_shared_turns_once(spark):
    turns = [("system", "s " * 50), ("user", "question")]
    rows = [(c, k, *t) for c in range(200) for k, t in enumerate([*turns, ("assistant", f"answer {c % 3}")])]
    sequences = C.chat_trees(frame(spark, rows).coalesce(1), PATH).where(F.size("members") > 0).collect()
    assert sum(len(r["members"]) for r in sequences) == 200
    # Two shared turns and three answers a sequence, whatever the number of copies.
    assert all(len(r["nodes"]) <= 5 for r in sequences) and sum(len(r["nodes"]) for r in sequences) < 40


def test_positions_go_on_over_parts(spark):
    rows = [(1, k, "user", "word " * 20) for k in range(50)]
    whole = C.chat_trees(frame(spark, rows), PATH).first()
    parts = C.chat_trees(frame(spark, rows), PATH, part_tokens=100).collect()
    assert sorted(x for r in parts for x in r["positions"]) == whole["positions"]
    assert sum(len(r["members"]) for r in parts) > 5


@pytest.mark.parametrize("limits", [{}, {"max_tokens": 300, "max_members": 7, "part_tokens": 200}])
def test_digests_are_made_where_texts_are_read(spark, tmp_path, limits):
    rows = conversations()
    out = C.digests(C.write_sequences(C.chat_trees(frame(spark, rows), PATH, **limits), str(tmp_path / "sequences")), PATH)
    # One worker reads and digests whole conversations; only cut ones go from a reader to another worker.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 3
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = set()
    for c, turns in grouped(rows).items():
        under = "".join(t for role, t in turns if role == "assistant")
        formatted = "".join(C.header(a) + C.escape(b) + "</turn>\n" for a, b in turns)
        expected.add((c, len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)), len(under), sha(under), len(formatted)))
    got = [tuple(r) for r in out.collect()]
    assert set(got) == expected and len(got) == len(expected)


def test_rows_that_go_to_a_worker_at_a_time(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    before = spark.conf.get(ARROW_ROWS)
    out = materialise(spark.range(100).coalesce(1).mapInArrow(sizes, "n long"), "sizes", batch_rows=7)
    assert sorted(r["n"] for r in out.collect()) == [2, *[7] * 14]
    assert spark.conf.get(ARROW_ROWS) == before


def test_empty(spark):
    empty = frame(spark, conversations()).limit(0)
    assert C.digests(C.chat_trees(empty, PATH), PATH).collect() == []


def test_template():
    for text in TEXTS:
        text = text or ""
        assert C.unescape(C.escape(text)) == text
        for role in ("user", "a: b", "\\:", "###", ""):
            assert C.parse_turn(C.header(role) + C.escape(text) + "</turn>\n") == (role, text)
    with pytest.raises(ValueError):
        C.parse_turn("### user: open")
