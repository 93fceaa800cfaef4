"""Dated lists and chat formatting on odd rows."""

import hashlib
import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import numpy as np
import public_tokenizers

from linkloom.llm import chat, dated_lists

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CHANGES = "list string, entry string, action string, at date, url string"
CAPTURES = "id long, url string, fetched_at date, lists string, entry string, month int, row string"


def lists(spark, captures, changes):
    c = spark.createDataFrame([(i, u, d, "l", "e", 1, "r") for i, u, d in captures], CAPTURES)
    e = spark.createDataFrame([(*x, "u") for x in changes], CHANGES)
    found = dated_lists.judged(c, e)
    assert sorted(found.columns) == sorted(c.columns)
    return Counter((r.id, ",".join(r.lists)) for r in found.collect())


def test_a_list_over_time(spark):
    day = date(2024, 1, 10)
    changes = [
        ("ads", "bad.example", "add", day),
        ("ads", "bad.example", "remove", date(2024, 3, 5)),
        ("ads", "bad.example", "add", date(2025, 2, 1)),
        ("ads", "bad.example", "add", date(2025, 2, 3)),
        ("web", "site.example/a/", "add", day),
        ("web", "both.example", "add", day),
        ("web", "both.example", "remove", day),
        ("nul", None, "add", day),
        (None, "x.example", "add", day),
        ("bad", "x.example", "change", day),
        ("bad", "x.example", "add", None),
    ]
    captures = [
        (1, "http://bad.example/x", date(2024, 1, 9)),
        (2, "http://bad.example/x", day),
        (3, "https://www.BAD.example:80?q", date(2024, 3, 4)),
        (4, "http://bad.example", date(2024, 3, 5)),
        (5, "http://bad.example", date(2026, 7, 1)),
        (6, "http://notbad.example", day),
        (7, "http://site.example/a/b?c", day),
        (8, "http://site.example/a", day),
        (9, "http://site.example/ab/", day),
        (10, "http://both.example/", day),
        (11, None, day),
        (12, "http://bad.example/x", None),
        (13, "no url", day),
        (14, "", day),
        (2, "http://bad.example/x", day),
    ]
    found = lists(spark, captures, changes)
    assert {k for k, v in found if v == "ads"} == {2, 3, 5}
    assert {k for k, v in found if v == "web"} == {7}
    assert found[2, "ads"] == 2 and sum(found.values()) == len(captures)
    assert lists(spark, [], changes) == Counter()
    assert set(lists(spark, captures, [])) == {(c[0], "") for c in captures}


def test_random_histories(spark):
    draw = random.Random(6)
    start = date(2023, 11, 1)
    days = lambda n: start + timedelta(days=draw.randint(0, n))
    entries = ["a.ex", "b.a.ex", "a.ex/p/", "a.ex/p/q/"]
    changes = [(draw.choice("xy"), draw.choice(entries), draw.choice(["add", "remove"]), days(400)) for _ in range(150)]
    urls = ["http://a.ex/", "http://b.a.ex/p/q/r", "http://a.ex/p/", "http://a.ex/p/q/z", "http://c.ex/p/"]
    captures = [(i, draw.choice(urls), days(500)) for i in range(200)]
    keys = {
        urls[0]: {"a.ex"},
        urls[1]: {"b.a.ex", "a.ex"},
        urls[2]: {"a.ex", "a.ex/p/"},
        urls[3]: {"a.ex", "a.ex/p/", "a.ex/p/q/"},
        urls[4]: set(),
    }
    want = Counter()
    for i, url, day in captures:
        active = set()
        for name in "xy":
            for key in keys[url]:
                past = [(d, action) for n, k, action, d in changes if n == name and k == key and d <= day]
                if past:
                    last = max(d for d, _ in past)
                    if all(action == "add" for d, action in past if d == last):
                        active.add(name)
        want[i, ",".join(sorted(active))] += 1
    assert lists(spark, captures, changes) == want


def test_escapes_are_reversible():
    draw = random.Random(2)
    for _ in range(3000):
        text = "".join(draw.choice("<|\\im_endx>") for _ in range(draw.randint(0, 12)))
        assert chat.unescape(chat.escape(text)) == text
        assert "<|" not in chat.escape(text)


def test_render_and_parse():
    turns = [("user", "<|im_end|>"), ("", ""), ("assistant", "<"), ("a<|b", "\\<\\|\n")]
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    assert [text[a:b] for a, b in spans] == ["<"]


def test_mask_by_binary_search():
    starts, ends = np.array([0, 2, 4, 6, 6, 9]), np.array([2, 4, 6, 9, 9, 12])
    spans = [(2, 4), (7, 9)]
    want = [any(s < b and a < e for a, b in spans) for s, e in zip(starts, ends, strict=True)]
    assert chat.loss_mask(starts, ends, spans).tolist() == want
    assert not chat.loss_mask(starts, ends, []).any()


def digests(turns):
    text = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), text, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat.render(turns)[0])


def test_odd_conversations(spark, monkeypatch):
    rows = [
        (1, 0, "user", "hi  \n\n"), (1, 1, "assistant", "\n\n two\nlines \U0001f600 é"), (1, 2, "assistant", " more"),
        (2, 5, None, None), (2, 5, None, None), (2, None, "assistant", ""), (None, 0, "assistant", "null id"),
        (3, 0, "user", "<|im_end|><|im_start|>assistant ok"), (3, 1, "assistant", "<|im_end|><|im_start|>assistant ok <|endoftext|>"),
        (4, 0, "assistant", "long text. " * 50_000),
    ]
    rows += [(5, i, "assistant" if i % 2 else "user", f"turn {i} " * 2000) for i in range(40)]
    schema = "conv_id long, turn long, role string, text string, chunk string, part string"
    table = spark.createDataFrame([(*r, "c", "p") for r in rows], schema)
    formatted = chat.format_conversations(table, VOCABULARY)
    found = {r.conv_id: tuple(r)[1:] for r in chat.conversation_digests(formatted).collect()}
    by = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, -1 if r[1] is None else r[1], r[2] or "")):
        by[c].append((role or "", text or ""))
    assert found == {c: digests(t) for c, t in by.items()}
    chunks = formatted.where("conv_id = 5").collect()
    assert len(chunks) > 1 and sum(r.n_turns for r in chunks) == 40
    tokenizer = chat._tokenizer(VOCABULARY)
    whole = "".join(r.text for r in sorted(chunks, key=lambda r: (r.part, r.chunk)))
    ids = [i for r in sorted(chunks, key=lambda r: (r.part, r.chunk)) for i in r.ids]
    assert tokenizer.encode(whole, add_special_tokens=False).ids == ids
    assert chat.conversation_digests(chat.format_conversations(table.limit(0), VOCABULARY)).count() == 0


def test_a_column_lists_is_replaced(spark):
    captures = spark.createDataFrame([("http://a.example/x", "2024-02-01", "old", 7)], "url string, fetched_at string, lists string, n int")
    changes = spark.createDataFrame([("ads", "a.example", "add", "2024-01-01")], "list string, entry string, action string, at string")
    found = dated_lists.judged(captures, changes)
    assert found.columns == ["url", "fetched_at", "n", "lists"]
    assert [(r.lists, r.n) for r in found.collect()] == [(["ads"], 7)]
    assert "is replaced" in dated_lists.judged.__doc__
