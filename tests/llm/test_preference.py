from tidemark.llm import preference as p


def slow(rows):
    """{pair: (prompt, chosen, rejected, trained texts)}."""
    out = {}
    for pair in {r[0] for r in rows if r[0] is not None}:
        sides = {s: [(r[3], r[4]) for r in sorted((r for r in rows if r[0] == pair and r[1] == s), key=lambda r: r[2])] for s in ("chosen", "rejected")}
        c, r = sides["chosen"], sides["rejected"]
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1
        show = lambda turns: "".join(f"<|im_start|>{a or ''}\n{b or ''}<|im_end|>\n" for a, b in turns)
        mask = lambda turns: [f"{b or ''}<|im_end|>\n" for a, b in turns if a == "assistant"]
        out[pair] = (show(c[:n]), show(c[n:]), show(r[n:]), mask(c[n:]), mask(r[n:]))
    return out


def side(pair, name, *turns):
    return [(pair, name, k, a, b) for k, (a, b) in enumerate(turns)]


U, A, S = ("user", "hi"), ("assistant", "hello"), ("system", None)
ROWS = [
    *side(1, "chosen", S, U, A, ("user", "more"), ("assistant", "yes 🙂")), *side(1, "rejected", S, U, A, ("user", "more"), ("assistant", "no")),
    *side(2, "chosen", U, A), *side(2, "rejected", U, A),  # equal
    *side(3, "chosen", U, A), *side(3, "rejected", U),  # one is a prefix of the other
    *side(4, "chosen", U, A),  # one side only
    *side(5, "chosen", ("user", ""), (None, "x")), *side(5, "rejected", ("user", None), (None, "x")),
    *side(6, "chosen", *[U, A] * 700, ("assistant", "a")), *side(6, "rejected", *[U, A] * 700, ("assistant", "b")),
    *side(None, "chosen", U), *side(None, "rejected", A),
]


def test_pairs(spark):
    turns = spark.createDataFrame([(*r, 9, "z") for r in ROWS], "pair_id long, side string, pos int, role string, text string, n_common int, part string").repartition(3)
    got = {r.pair_id: r for r in p.assembled(p.rendered(turns)).collect()}
    want = slow(ROWS)
    assert set(got) == set(want)
    for pair, (prompt, chosen, rejected, c, r) in want.items():
        row = got[pair]
        assert (row.prompt, row.chosen, row.rejected) == (prompt, chosen, rejected)
        assert [row.chosen[s.start : s.end] for s in row.chosen_spans] == c and [row.rejected[s.start : s.end] for s in row.rejected_spans] == r
    assert 6 not in {r.pair_id for r in p.assembled(p.rendered(turns), max_turns=1000).collect()}


def test_conversations(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "abcde"), (1, 2, "user", "dropped"), (2, 0, "user", "only"), (3, 0, "assistant", ""), (1, None, "user", "no turn"), (1, 0, "user", "q"), (None, 0, "user", "x")]
    conv = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r.pair_id: (r.prompt, r.chosen, r.rejected) for r in p.assembled(p.rendered(p.against_truncated(conv))).collect()}
    show = lambda a, b: f"<|im_start|>{a}\n{b}<|im_end|>\n"
    assert got == {1: (show("user", "q"), show("assistant", "abcde"), show("assistant", "ab")), 2: (show("user", "only"), "", ""), 3: (show("assistant", ""), "", "")}
    assert p.rendered(p.against_truncated(conv.limit(0))).count() == 0
