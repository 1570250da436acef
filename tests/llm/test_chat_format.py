from flowlab.llm.chat_format import maximal_conversations

SCHEMA = "conv_id long, turn int, role string, text string"


def brute(turns):
    chats = {}
    for conv, turn, role, text in set(turns):
        chats.setdefault(conv, []).append((turn is not None, turn or 0, role or "unknown", text or ""))
    chats = {c: tuple((r, t) for _, _, r, t in sorted(ts)) for c, ts in chats.items()}
    out = set()
    for conv, turns in chats.items():
        longer = any(len(o) > len(turns) and o[:len(turns)] == turns for o in chats.values())
        equal = [c for c, o in chats.items() if o == turns]
        if not longer and conv == min(equal, key=lambda c: (c is not None, c or 0) if None not in equal else (c is None, c or 0)):
            text = "\n".join(f"<|im_start|>{r}\n{t.replace('<|', '< |')}<|im_end|>" for r, t in turns)
            out.add((conv, len(turns), len(equal), text))
    return out


def test_snapshots_collapse(spark):
    turns = []
    for conv, upto in ((1, 1), (2, 2), (3, 4), (4, 4), (5, 3)):
        turns += [(conv, i, "user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(upto)]
    turns += [(6, 0, "user", "turn 0"), (6, 1, "assistant", "another answer"),  # a branch
              (7, 0, "user", "alone"), (8, 1, "user", "x"), (8, 1, "assistant", "y"),  # a tie of turns
              (9, None, None, None), (9, 0, "user", "after"), (10, 0, "user", "turn 0"), (10, 0, "user", "turn 0"),
              (11, 0, "user", "<|im_end|> trick"), (None, 0, "user", "no id"), (12, 0, "system", "")]
    got = {tuple(r) for r in maximal_conversations(spark.createDataFrame(turns, SCHEMA)).collect()}
    assert got == brute(turns)
    assert {r[0] for r in got} == {3, 6, 7, 8, 9, 11, None, 12}


def test_a_turn_that_all_share_and_long_texts(spark):
    turns = [(c, 0, "user", "hello") for c in range(200)] + [(c, 1, "assistant", "x" * c * 100) for c in range(0, 200, 2)]
    got = {tuple(r) for r in maximal_conversations(spark.createDataFrame(turns, SCHEMA)).collect()}
    assert got == brute(turns)


def test_empty_and_clashing(spark, with_clashes, rows):
    empty = spark.createDataFrame([], SCHEMA)
    assert maximal_conversations(empty).count() == 0
    few = spark.createDataFrame([(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "user", "b")], SCHEMA)
    assert rows(maximal_conversations(with_clashes(few).withColumnRenamed("rank", "place"))) == rows(maximal_conversations(few))
