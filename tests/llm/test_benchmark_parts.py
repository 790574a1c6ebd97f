"""A benchmark of many parts gives what one part gives, and long items are cut without losing windows."""

import random
import re

from daybook.llm import positional_index


def test_rounds(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(40)]
    items = {str(i): " ".join(rng.choices(words, k=k)) for i, k in enumerate([3, 3, 4, 4, 5, 70, 1, 0])}
    items["8"] = items["5"]  # the same windows belong to two items
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(items.items()), "item_id string, text string")

    def brute(text):
        have, hit, found = text.split(), set(), set()
        for name, item in items.items():
            want = item.split()
            n = min(4, len(want))
            grams = {tuple(want[i:i + n]) for i in range(len(want) - n + 1)} if n else set()
            for i in range(len(have)):
                if n and tuple(have[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    found.add(name)
        return hit, sorted(found)

    for most in (500_000, 7):
        monkeypatch.setattr(positional_index, "PART_WORDS", most)
        parts = positional_index.windows(bench, 4)
        rounds = positional_index._rounds(parts)
        assert len(rounds) == 1 if most > 7 else len(rounds) > 5
        assert parts.where(f"n > {2 * most}").count() == 0
        rows = positional_index.matches(docs, bench, 4).collect()
        assert len(rows) == len(texts)
        for r in rows:
            hit, found = brute(texts[r.doc_id])
            assert {p for s in r.spans for p in range(s["first"], s["last"] + 1)} == hit
            assert r.items == found and r.n_words == len(re.findall(r"\S+", texts[r.doc_id]))
