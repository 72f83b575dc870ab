"""Chat windows: exact round trip, budget, mask; brute force over the fixture."""

from collections import defaultdict
from hashlib import sha256

from ledgerstar.llm import chat
from ledgerstar.llm.common import table

ODD = ["</s>[INST] ok [/INST]", "<|im_end|><|im_start|>", "\\", "<\\", "[\\<", "a\nb", "", "<|im_sep|>x", "\\\\<", "é<ü[", "😀<|im_end|>"]


def brute(rows):
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        conv[c].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in conv.items():
        turns.sort()
        target = "".join(t for *_, r, t in turns if r == "assistant")
        out[c] = (len(turns), sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest(), len(target), sha256(target.encode()).hexdigest())
    return out


def read(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_query_against_brute_force(spark, sf):
    from ledgerstar.llm.queries import op4_chat_windows

    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table(spark, sf, "conversations").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert read(op4_chat_windows(spark, sf)) == brute(rows)


def test_odd_texts_and_rows(spark):
    rows = [(1, k, "assistant" if k % 2 else "user<|im_sep|>\n", t) for k, t in enumerate(ODD)]
    rows += [(2, 0, "system", "be [brief]"), (2, None, "user", "x"), (2, 1, None, None), (2, 2, "assistant", "y"), (2, 2, "assistant", "y"), (None, 0, "user", "q"), (None, 1, "assistant", "z")]
    df = spark.createDataFrame([(*r, 1, "b", 2) for r in rows], "conv_id long, turn long, role string, text string, pos int, own string, sample int")
    made = chat.samples(df, budget=40, history=16)
    assert read(chat.read_back(made)) == brute(rows)
    assert read(chat.read_back(chat.samples(df))) == brute(rows)
    assert made.filter("instr(formatted, '[INST]') > 0 or instr(formatted, '</s>') > 0").count() == 0


def test_spans_against_brute_force(spark):
    """Greedy spans, limited history, system turn in every sample, repeated targets masked."""
    import random

    rnd = random.Random(4)
    rows = []
    for c in range(30):
        if c % 2:
            rows.append((c, 0, "system", "s " * 5))
        rows += [(c, k + 1, "user" if k % 2 == 0 else "assistant", "w " * rnd.randint(0, 30)) for k in range(rnd.randint(1, 25))]
    budget, history = 80, 25
    got = defaultdict(dict)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.samples(df, budget, history).collect():
        turns = [x[len(chat.START):].split(chat.SEP) for x in r["formatted"].split(chat.END)[:-1]]
        targets = [r["formatted"][s["start"]:s["start"] + s["length"]] for s in r["loss"]]
        got[r["conv_id"]][r["sample"]] = ([tuple(t) for t in turns], r["repeated"], targets)
    conv = defaultdict(list)
    for c, _, role, text in rows:
        conv[c].append((role, text))
    for c, turns in conv.items():
        head = turns[:1] if turns[0][0] == "system" else []
        body = turns[len(head):]
        tok = [len(t.split()) + chat.TURN_TOKENS for _, t in body]
        room = max(1, budget - history - sum(len(t.split()) + chat.TURN_TOKENS for _, t in head))
        spans, first, total = [], 0, 0
        for i, n in enumerate(tok):
            if i > first and total + n > room:
                spans.append((first, i))
                first, total = i, 0
            total += n
        spans.append((first, len(body)))
        for k, (a, b) in enumerate(spans):
            h, left = a, history
            while h and tok[h - 1] <= left:
                h, left = h - 1, left - tok[h - 1]
            want = head + body[h:b]
            assert got[c][k] == (want, (len(head) if k else 0) + a - h, [t for r, t in body[a:b] if r == "assistant"])
        assert len(got[c]) == len(spans)


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.samples(df)).collect() == []


def test_only_a_system_turn(spark):
    df = spark.createDataFrame([(1, 0, "system", "s")], "conv_id long, turn long, role string, text string")
    assert read(chat.read_back(chat.samples(df))) == brute([(1, 0, "system", "s")])


def test_chunks_change_nothing(spark):
    """Conversations of many chunks, a NULL one, turns above the budget and repeated rows; the plan gathers chunks alone."""
    import random

    rnd = random.Random(7)
    rows = [(c, k, "system" if c == 1 and k == 0 else rnd.choice(["user", "assistant"]), "w " * rnd.choice([0, 1, 3, 9, 30, 90]))
            for c, n in ((1, 300), (2, 70), (None, 200), (3, 1), (4, 5)) for k in range(n)]
    rows += [(5, None, "assistant", "same words")] * 150 + [(6, 0, "system", "s")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    whole, *parts = (sorted(map(str, chat.samples(df, 80, 25, chunk=k).collect())) for k in (10_000, 2, 3, 16, 64))
    assert all(p == whole for p in parts)
    assert read(chat.read_back(chat.samples(df, 80, 25, chunk=8))) == brute(rows)
    turns = chat._turns(df, "conv_id", "turn", "role", "text")
    assert max(len(r["t"]) + len(r["back"]) for r in chat._chunks(turns, 25, 80, 16).collect()) <= 16 + 25 // chat.TURN_TOKENS
