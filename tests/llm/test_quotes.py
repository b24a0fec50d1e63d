"""Quotation linking against a plain recursive reading of the reply tree."""

import random

import pytest

from crawlcat.llm import quotes


def test_parse_nested_levels():
    body, passages = quotes.parse("> > deep one\n> > more\n> upper\n\nMy answer\n>tail\nend")
    assert body == "\nMy answer\nend".strip("\n") and passages == [(2, "deep one\nmore"), (1, "upper"), (1, "tail")]
    assert quotes.hashed("Hello,  WORLD") == quotes.hashed("hello world") and quotes.hashed("?!") is None


def plain(rows):
    """{(conv, turn): (parent, place)} by hand."""
    out = {}
    convs = {}
    for c, t, _, text in rows:
        if t is not None:
            convs.setdefault(c, {}).setdefault(t, []).append(text or "")
    for c, turns in convs.items():
        own = {t: set().union(*(quotes.parts(quotes.parse(x)[0]) for x in texts)) for t, texts in turns.items()}
        parent = {}
        for t, texts in turns.items():
            best = None
            for d, p in [q for x in texts for q in quotes.parse(x)[1]]:
                for s in sorted(turns):
                    for _, n in own[s] & quotes.parts(p) if s < t else ():
                        best = max(best, (-d, n, s)) if best else (-d, n, s)
            if best:
                parent[t] = best[2]
        order, kids, last = sorted(turns), {}, None
        for t in order:
            up = parent.get(t, last)
            kids.setdefault(up, []).append(t)
            last = t
        reading, stack = [], list(reversed(kids.get(None, [])))
        while stack:
            t = stack.pop()
            reading.append(t)
            stack += sorted(kids.get(t, []), reverse=True)
        place, seen = {}, -1
        for t in reading:
            if t == order[0] or t in parent:
                seen += 1
                place[t] = seen
        run = None
        for t in order:
            run = t if t in parent or run is None else run
            out[c, t] = (parent.get(t), place[run])
    return out


def thread(r, c, n):
    rows, said = [], []
    for t in range(n):
        text = " ".join(r.choices([f"w{i}" for i in range(50)], k=6))
        if t and r.random() < 0.5:
            source = r.randrange(t)
            text = f"> {said[source]}\n{text}"
            if r.random() < 0.4:
                text = f"> > {said[r.randrange(t)]}\n" + text
        said.append(quotes.parse(text)[0])
        rows.append((c, 3 * t, "user" if t % 2 else None, text))
    return rows


def test_order_equals_a_plain_reading(spark, monkeypatch):
    monkeypatch.setattr(quotes, "TURNS", 8)
    r = random.Random(9)
    rows = [x for c in range(6) for x in thread(r, c, 25)] + thread(r, None, 8) + [(90, t, "user", "plain") for t in range(3)]
    rows += [(91, None, "user", "> plain"), (91, 1, None, None), (92, 0, "a", "same"), (92, 0, "a", "same"), (92, 1, "b", "> same\nyes"), (92, 1, "b", "> same\nyes")]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as parent", "'x' as run", "2 as hash")
    got = quotes.format_chat(messages).collect()
    want = plain(rows)
    assert len(got) == len(rows)
    for x in got:
        if x["turn"] is not None:
            assert (x["parent"], x["run_place"]) == want[x["conv_id"], x["turn"]], x
        assert ">" not in x["text"]
    assert any(p is not None for p, _ in want.values())
    assert quotes.rendered(quotes.format_chat(messages)).where("chat like '<|unknown|>%'").count() > 0


def test_sentences_and_wrapped_parts(spark):
    said = "The first point is short. The second point, which matters, needs a longer answer than that. Yes."
    rows = [
        (1, 0, "a", said), (1, 1, "b", "Something else. Yes."),
        (1, 2, "c", "> The second point, which\n> matters, needs a longer\n> answer than that. Yes.\nI agree."),
        (1, 3, "d", "> Yes.\nNo."), (1, 4, "e", "> not said by anyone\nHm."), (2, 0, "a", "> The first point is short.\nin another conversation"),
        (1, 5, "f", "> " + "very long " * 50_000 + "\n" + "x" * 300_000),
    ]
    got = {(r["conv_id"], r["turn"]): r for r in quotes.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k: r["parent"] for k, r in got.items()} == {(1, 0): None, (1, 1): None, (1, 2): 0, (1, 3): 1, (1, 4): None, (1, 5): None, (2, 0): None}
    assert got[1, 2]["text"] == "I agree." and got[1, 5]["text"] == "x" * 300_000 and got[1, 4]["n_passages"] == 1


def test_links_over_many_conversations(spark):
    r = random.Random(12)
    rows = [x for c in range(300) for x in thread(r, c, r.randint(1, 12))] + thread(r, 999, 400)
    got = quotes.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = plain(rows)
    assert len(got) == len(rows) and not [x for x in got if (x["parent"], x["run_place"]) != want[x["conv_id"], x["turn"]]]
    assert sum(x["reply"] for x in got) > 500


@pytest.mark.parametrize("where", ["false", "true"])
def test_without_quotes(spark, sf_dir, where):
    messages = spark.read.parquet(f"{sf_dir}/conversations.parquet").where(where)
    got = quotes.format_chat(messages)
    assert got.count() == messages.count() and got.where("reply").count() == 0
