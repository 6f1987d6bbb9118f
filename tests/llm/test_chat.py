import random
from hashlib import sha256

from headway.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, place long, chunk string"
HARD = ["", "</turn>", "<turn user>", "\\", "\\\\l<", "\\### Assistant: </turn> ok", "probe", "é\n<|im_end|>\n", "中" * 50, "a\\", "\\g>"]


def rows():
    rnd = random.Random(6)
    out = []
    for c in range(40):
        for t in range(rnd.randint(1, 30)):
            out.append((c, t, rnd.choice(["system", "user", "assistant", "a<b>", "probe"]), " ".join(rnd.choice(HARD) for _ in range(rnd.randint(0, 4)))))
    out += [(50, t, "assistant", "x" * 10) for t in range(3000)]
    out += [(51, 1, None, None), (51, None, "assistant", "first"), (51, 1, "assistant", None), (None, 0, "user", "hi"), (None, 1, "assistant", "yo")]
    return out + [(52, 0, "assistant", "same"), (52, 0, "assistant", "same"), (53, 0, "assistant", "long " * 100_000)]


def frame(spark, found):
    return spark.createDataFrame([(*r, 1, "clash") for r in found], SCHEMA)


def brute(found):
    by = {}
    for c, t, r, x in found:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, ts in by.items():
        ts.sort(key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))
        text = "".join(f"{r}\n{x}\n" for *_, r, x in ts)
        loss = "".join(x for *_, r, x in ts if r == "assistant")
        whole = chat.turns([(r, x) for *_, r, x in ts])
        out[c] = (len(ts), sha256(text.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest(), len(whole), False)
    return out


def test_round_trip(spark):
    out = chat.digest(chat.format_turns(frame(spark, rows()))).collect()
    assert {r.conv_id: tuple(r)[1:] for r in out} == brute(rows())


def test_chunks_join_to_the_whole_rendering(spark):
    found = [r for r in rows() if r[0] in (1, 2, 3)]
    out = chat.format_turns(frame(spark, found)).collect()
    for c in (1, 2, 3):
        got = "".join(r.chunk for r in sorted((r for r in out if r.conv_id == c), key=lambda r: r.place))
        assert got == chat.turns([(r, x) for _, _, r, x in sorted(r for r in found if r[0] == c)])
        assert [t for t in chat.read_turns(got)] == [(r, x) for _, _, r, x in sorted(r for r in found if r[0] == c)]


def forgetful(turns):
    """Drops what earlier assistant turns thought."""
    last = len(turns) - 1
    return "".join(f"[{r}] {x.split('THINK')[0] if i < last and r == 'assistant' else x}\n" for i, (r, x) in enumerate(turns))


def test_template_that_rewrites_history(spark):
    found = [(1, 0, "user", "q"), (1, 1, "assistant", "a THINK b"), (1, 2, "user", "r"), (1, 3, "assistant", "c"), (2, 0, "user", "q"), (2, 1, "assistant", "a"), (2, 2, "user", "r")]
    out = chat.format_turns(frame(spark, found), forgetful).collect()
    assert [(r.conv_id, r.place) for r in out if r.rewrites] == [(1, 2), (1, 3)] or sorted((r.conv_id, r.place) for r in out if r.rewrites) == [(1, 2), (1, 3)]
    assert sorted((r.conv_id, r.chunk[r.start : r.end]) for r in out if r.loss) == [(1, "a THINK b"), (2, "a")]


def test_spans_under_other_templates():
    def with_preamble(turns):
        return "<<BEGIN>>" + "".join(f"({r}: {x})" for r, x in turns)

    inc = chat.Incremental(with_preamble, context=2)
    for role, text in [("user", "a"), ("assistant", ")("), ("user", ""), ("assistant", "probe"), ("assistant", "(x: y)")]:
        chunk, a, b, rewrites = inc.add(role, text)
        assert chunk[a:b] == text and not rewrites


def test_empty(spark):
    assert chat.digest(chat.format_turns(frame(spark, []))).collect() == []


def test_long_conversations_are_rendered_whole():
    def alternating(turns):
        assert all(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        return "".join(f"({r}: {x})" for r, x in turns)

    def numbering(turns):
        return "".join(f"{i} {r}: {x}\n" for i, (r, x) in enumerate(turns))

    def keeps_ten(turns):
        return "".join(f"({r}: {x})" for r, x in turns[-10:])

    said = [(("user", "assistant")[i % 2], f"text {i}") for i in range(16)]
    for template, first_rewrite in ((alternating, 16), (numbering, 16), (keeps_ten, 10)):
        inc = chat.Incremental(template)
        found = [inc.add(*t) for t in said]
        assert [f[3] for f in found] == [i >= first_rewrite for i in range(16)]
        assert all(c[a:b] == x for (c, a, b, rewrites), (_, x) in zip(found, said) if not rewrites)
        if first_rewrite == 16:
            assert "".join(f[0] for f in found) == template(said)


def test_only_a_declared_context_bounds_what_stays():
    for template, kept in ((chat.turns, chat.CONTEXT + 1), (lambda turns: chat.turns(turns), 30)):
        inc = chat.Incremental(template)
        for i in range(30):
            inc.add("user", str(i))
        assert len(inc.seen) == kept
