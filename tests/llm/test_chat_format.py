import random
from collections import defaultdict
from hashlib import md5, sha256

import pytest

from newsflow.llm import chat_format as op

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[SYS]", "[/SYS]", "[ROLE=", "[/ROLE]", "\\", "<", "[", "<\\s>",
            "[\\\\/INST]", " ", "]", "\n", "a", "日"]


def noisy(rng, n):
    return "".join(rng.choice(CONTROLS) for _ in range(n))


def test_escaping_is_reversible():
    rng = random.Random(3)
    for _ in range(3000):
        t = noisy(rng, rng.randrange(12))
        e = op.escape(t)
        assert op.unescape(e) == t and not any(c in e for c in CONTROLS[:9])
        for role in ("user", "assistant", "system", "", "tool/x]", "[INST] a", "100 %"):
            segment, start, length = op.render(role, t)
            assert op.read_turn(segment) == (role, t) == op.read_turn(op.BEGIN + segment)
            assert segment[start:start + length] == e


@pytest.mark.parametrize("bad", ["[INST] a", "[INST] a [INST] b [/INST]", "a", "[OUT] <s> </s>"])
def test_reading_rejects_what_is_no_turn(bad):
    with pytest.raises(ValueError):
        op.read_turn(bad)


def fold_brute(events):
    """Final ``(position, role, text, message)`` lists by conversation."""
    by = defaultdict(list)
    for conv, position, message, seq, kind, role, text in events:
        if seq is not None and kind in op.KINDS:
            by[conv, message].append((seq, kind, role or "", text or "", position))
    convs = defaultdict(list)
    for (conv, message), es in by.items():
        es.sort(key=lambda e: e[:4])
        seen, role, text, gone = set(), "", "", False
        for seq, kind, who, t, position in es:
            if seq in seen:
                continue
            seen.add(seq)
            if kind == "open":
                role = who
            elif kind == "delta":
                text += t
            elif kind == "edit":
                text = t
            elif kind == "regenerate":
                text = ""
            else:
                gone = True
        if not gone:
            convs[conv].append((es[0][4], role, text, message))
    key = lambda m: (m[0] is None, m[0] or 0, m[1], md5(m[2].encode()).hexdigest(), m[3])
    return {c: sorted(ms, key=key) for c, ms in convs.items()}


def digests(turns):
    said = "".join(t for _, r, t, _ in turns if r == "assistant")
    return (len(turns), sha256("".join(f"{r}\n{t}\n" for _, r, t, _ in turns).encode()).hexdigest(), len(said),
            sha256(said.encode()).hexdigest(), 3 + sum(len(op.render(r, t)[0]) for _, r, t, _ in turns))


def test_fold_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(op, "FLUSH_BYTES", 300)
    rng = random.Random(5)
    events = []
    for message in range(200):
        conv, position = rng.choice([1, 2, 3, None, -7, 3, 3]), rng.choice([None, 0, 1, 2, 3, 3])
        events.append((conv, position, message, 0, "open", rng.choice(["user", "assistant", "system", "tool", None]), None))
        for seq in range(1, rng.randrange(8)):
            kind = rng.choice(["delta", "delta", "delta", "edit", "regenerate", "remove" if rng.random() < 0.2 else "delta", "odd"])
            events.append((conv, position, message, seq, kind, None, noisy(rng, 4) if kind != "regenerate" else None))
        if rng.random() < 0.3:
            events.append(events[-1])  # delivered twice
    events += [(1, 0, 900, None, "delta", None, "no sequence"), (9, 0, 901, 5, "delta", None, "never opened")]
    rng.shuffle(events)
    log = spark.createDataFrame(events, op.LOG).repartition(5)
    want = fold_brute(events)
    placed = op.format_chats(log)
    got = {r.conv_id: tuple(r)[1:] for r in op.read_back(placed).collect()}
    assert got == {c: digests(ts) for c, ts in want.items()}
    text, masked = defaultdict(str), defaultdict(str)
    for r in sorted(placed.collect(), key=lambda r: (str(r.conv_id), r.place)):
        assert r.start == len(text[r.conv_id])
        text[r.conv_id] += r.segment
        masked[r.conv_id] += op.unescape(text[r.conv_id][r.loss_start:r.loss_start + r.loss_length])
    for c, ts in want.items():
        assert text[c] == "<s>" + "".join(op.render(r, t)[0] for _, r, t, _ in ts)
        assert masked[c] == "".join(t for _, r, t, _ in ts if r == "assistant")


def test_empty_log(spark):
    log = spark.createDataFrame([], op.LOG)
    assert op.format_chats(log).count() == 0 and op.read_back(op.format_chats(log)).count() == 0


def query(spark, path, rows):
    from newsflow.llm.queries import QUERIES
    data = [(*r, "x", 1) for r in rows]
    spark.createDataFrame(data, "conv_id long, turn long, role string, text string, segment string, seq int").repartition(
        3).write.parquet(f"{path}/conversations.parquet")
    return {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_chat_format"](spark, str(path)).collect()}


def test_query_on_edge_rows(spark, tmp_path):
    long_text = "long </s> text [INST] " * 30_000
    rows = [(1, 0, "system", "be [SYS] good"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, 2, "assistant", ""),
            (1, 2, "assistant", "b"), (2, 5, "assistant", long_text), (2, 4, "user", long_text), (3, None, None, None),
            (3, 0, "tool", "</s>"), (None, 0, "user", "x"), (None, 1, "assistant", "y\U0001f389" * 600), (4, 1, "user", "<\\s>")]
    rows += [(5, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(2000)]  # one long conversation
    extra = [(-7, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(["user", "assistant"])]
    convs = defaultdict(list)
    for m, (c, t, r, x) in enumerate(rows + extra):
        convs[c].append((t, r or "", x or "", m))
    key = lambda m: (m[0] is None, m[0] or 0, m[1], md5(m[2].encode()).hexdigest(), m[3])
    assert query(spark, tmp_path, rows) == {c: digests(sorted(ts, key=key)) for c, ts in convs.items()}


def test_query_on_an_empty_table(spark, tmp_path):
    assert list(query(spark, tmp_path, [])) == [-7]
