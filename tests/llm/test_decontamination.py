from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from wheelhouse.llm import decontamination as dec

ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "short, ITEM!"),
    (3, "été café 10"),
    (4, None),
    (5, "..."),
    (6, "alpha BETA gamma delta epsilon zeta eta theta iota kappa"),
]


def brute(text: str | None, items: list[tuple[int, str | None]]) -> tuple[int, int, list[str]]:
    words, hit, names = _words(text), set(), set()
    for item, body in items:
        own = _words(body)
        size = min(len(own), 10)
        wins = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1) if wins else ():
            if tuple(words[i : i + size]) in wins:
                hit |= set(range(i, i + size))
                names.add(str(item))
    return len(words), len(hit), sorted(names)


def _words(text: str | None) -> list[str]:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in _split(lowered) if w]


def _split(text: str) -> list[str]:
    out, word = [], ""
    for c in text:
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) > 127:
            word += c
        else:
            out.append(word)
            word = ""
    return [*out, word]


def _scan(texts: list[str | None], items) -> list[tuple[int, int, list[str]]]:
    rows = []
    for item, body in items:
        own = _words(body)
        size = min(len(own), 10)
        rows += [(str(item), " ".join(own[i : i + size])) for i in range(len(own) - size + 1)] if own else []
    windows, out = dec.Windows(rows), []
    for text in texts:
        normal, n_words = dec.normalise(text or "")
        ranges, names = windows.scan(normal)
        out.append((n_words, sum(b - a for a, b in dec.merged(ranges)), sorted(names)))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "É", "a-b", "A", " ", " ", "7"]), max_size=60), st.lists(st.sampled_from("a b É A".split()), max_size=14))
def test_scan_equals_brute_force(parts, item):
    text, items = " ".join(parts), [(1, " ".join(item)), (2, "a b")]
    assert _scan([text], items) == [brute(text, items)]


def test_tables(spark, monkeypatch):
    texts = [
        "x Alpha, beta gamma delta epsilon zeta eta theta iota kappa lambda y",
        "a short item; and a short   item",
        None,
        "",
        "été CAFÉ 10 été café 10",
        "alpha beta",
        "été café 10" * 3,
        "word " * 30000 + "short item",
    ]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(1, texts[1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for limit in (dec.BLOCK_CHARS, 100):
        monkeypatch.setattr(dec, "BLOCK_CHARS", limit)
        got = dec.find_items(docs, items).collect()
        assert len(got) == len(rows)
        for row in got:
            assert (row.n_words, row.n_hit, row.hit_items) == brute(row.text, ITEMS)
        spans = {row.doc_id: [row.text[s.start : s.end] for s in row.hit_spans] for row in got}
        assert spans[0] == ["Alpha, beta gamma delta epsilon zeta eta theta iota kappa lambda"]
        assert spans[1] == ["short item", "short   item"] and spans[2] == []
    kept = dec.clean_documents(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6]
    assert dec.find_items(docs.limit(0), items).count() == 0
    assert dec.find_items(docs, items.limit(0)).where("n_hit > 0").count() == 0
