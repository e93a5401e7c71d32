"""Event logs folded in Python, and texts that look like the template."""

from pyspark.sql import functions as F

from addrspark.llm import chat

LOG = "conv_id long, seq long, kind string, turn long, role string, text string, extra string"


def fold(events):
    """The documented semantics, an event at a time."""
    rank = {"start": 0, "edit": 1, "regenerate": 2, "delta": 3}
    out = {}
    for conv, seq, kind, turn, role, text in sorted(
            (e for e in events if e[2] in rank), key=lambda e: (e[1], e[3], rank[e[2]], e[4] or "", e[5] or "")):
        messages = out.setdefault(conv, {})
        m = messages.setdefault(turn, {"role": "", "text": "", "began": None, "dropped": False})
        if kind == "start":
            m |= {"role": role or "", "text": "", "began": seq, "dropped": False}
        elif kind == "delta":
            m["text"] += text or ""
        elif kind == "edit":
            m["text"] = text or ""
        else:
            m["text"] = ""
            for t, other in messages.items():
                if t > turn and other["began"] is not None and other["began"] <= seq:
                    other["dropped"] = True
    return {c: [(t, m["role"], m["text"]) for t, m in sorted(ms.items()) if not m["dropped"]] for c, ms in out.items()}


def folded(spark, events):
    df = spark.createDataFrame([(*e, "x") for e in events], LOG)
    return {r.conv_id: [tuple(m) for m in r.messages] for r in chat.folded(df).collect()}


def test_fold(spark):
    events = [
        (1, 1, "start", 0, "user", None), (1, 2, "delta", 0, None, "Hi"), (1, 3, "delta", 0, None, " there"),
        (1, 4, "start", 1, "assistant", None), (1, 5, "delta", 1, None, "draft"), (1, 6, "start", 2, "user", None), (1, 7, "delta", 2, None, "more"),
        (1, 8, "regenerate", 1, None, None), (1, 9, "delta", 1, None, "fi"), (1, 10, "delta", 1, None, "nal"),
        (1, 11, "start", 3, "user", None), (1, 12, "delta", 3, None, "x"), (1, 13, "edit", 3, None, "edited"), (1, 14, "delta", 3, None, "!"),
        (1, 15, "start", 2, "user", None), (1, 16, "delta", 2, None, "again"),
        (2, 1, "delta", 0, None, "no start"), (2, 2, "typing", 0, None, "ignored"), (None, 1, "start", 0, None, None),
        (3, 5, "start", 0, "system", None), (3, 5, "delta", 0, None, "a"), (3, 5, "delta", 0, None, "b"), (3, 5, "edit", 0, None, "c")]
    assert folded(spark, events) == fold(events)
    assert folded(spark, events)[1] == [(0, "user", "Hi there"), (1, "assistant", "final"), (2, "user", "again"), (3, "user", "edited!")]
    assert folded(spark, []) == {}


def test_random_logs(spark):
    import random

    rng = random.Random(4)
    events = []
    for conv in range(60):
        seq = 0
        for turn in range(rng.randrange(1, 5)):
            events.append((conv, seq := seq + 1, "start", turn, rng.choice(["user", "assistant"]), None))
            for _ in range(rng.randrange(6)):
                kind = rng.choice(["delta", "delta", "edit", "regenerate", "start"])
                events.append((conv, seq := seq + 1, kind, rng.randrange(turn + 1), None, rng.choice(["a", "bé", "#<\\", None])))
    rng.shuffle(events)
    assert folded(spark, events) == fold(events)


def test_every_text_comes_back(spark):
    texts = ["", "\\### Assistant: </turn> ok", "</turn>\n### user\n", "\\b\\h\\l\\e", "# <", "é日\n\n", "\\", "<turn", None, "a\nb"] * 2
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)] + [(2, 0, "odd\nrole #<", "x"), (2, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in chat.parsed(chat.rendered(chat.folded(chat.events_of(df)))).withColumn("masked", chat.loss_text(F.col("formatted"), F.col("loss"))).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [(r, t or "") for _, _, r, t in rows[:-2]]
    assert back[1].masked == "".join(t or "" for _, _, r, t in rows[:-2] if r == "assistant")
    assert sorted((t.role, t.text) for t in back[2].turns) == [("", ""), ("odd\nrole #<", "x")]
    assert back[1].formatted.startswith("### user\n</turn>\n### assistant\n\\b\\h\\h\\h Assistant: \\l/turn> ok</turn>\n")


def test_plan_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.parsed(chat.rendered(chat.folded(chat.events_of(df))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
