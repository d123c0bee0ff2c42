import random

from rowtide.llm import decontam as d


def fixture():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    common = ["the", "of", "and", "to"]
    sentence = lambda n: " ".join(rng.choice(common) if rng.random() < 0.4 else word() for _ in range(n))
    items = [(k, f"{sentence(rng.randint(12, 30))}. {sentence(6)}.") for k in range(70)]
    rows, leaks = [], set()
    for i in range(120):
        parts = [sentence(rng.randint(0, 150))]
        if i % 4 == 0:
            k = rng.randrange(70)
            parts.insert(rng.randint(0, 1), items[k][1].upper())
            leaks.add((i, k))
        if i % 9 == 0:  # a question without its answer is no leak
            k = rng.randrange(70)
            if (i, k) not in leaks:
                parts.append(" ".join(d.question_and_answer(items[k][1])[0][:8]))
        rows.append((i, "\n".join(parts)))
    return items, rows, leaks


def test_finds_planted_items_and_nothing_else(spark, documents, odd_rows):
    items, rows, leaks = fixture()
    tests = spark.createDataFrame(items + [(900, None), (901, ""), (902, " . "), (903, "one two three")], "item_id long, text string")
    docs = documents(rows + [(None if i is None else i + 1000, x) for i, x in odd_rows])
    got = {(r.doc_id, r.item_id) for r in d.contamination(docs, tests).collect()}
    assert got == leaks | {(1005, 903), (1006, 903), (None, 903)}
    kept = d.keep_clean(docs, tests)
    assert kept.columns == docs.columns
    assert kept.count() == len(rows) + len(odd_rows) - len({i for i, _ in leaks}) - 4


def test_shards_give_the_same_leaks(spark, documents):
    items, rows, leaks = fixture()
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.contamination(documents(rows), tests, shard_items=25).collect()}
    assert got == leaks


def test_pruned_retrieval_equals_full_scoring():
    import numpy as np

    items, rows, _ = fixture()
    df = {}
    for _, x in items:
        for w in set(d.words_of(x)):
            df[w] = df.get(w, 0) + 1
    mean = sum(len(d.words_of(x)) for _, x in items) / len(items)
    index = d.Index(items, df, len(items), mean, block=4)
    rng = random.Random(1)
    passage, term, full = [], [], []
    for p, (_, text) in enumerate(rows):
        own = sorted({index.terms[w] for w in d.words_of(text) if w in index.terms})
        passage += [p] * len(own)
        term += own
        score = np.zeros(len(items))
        for w in own:
            at = slice(index.first[w], index.first[w + 1])
            score[index.item[at]] += index.share[at]
        full += [(p, k) for k in np.flatnonzero(score >= 0.15 - 1e-9).tolist()]
    got = index.retrieve(np.array(passage), np.array(term), len(rows), 0.15)
    assert rng and sorted((p, k) for p, k, _ in got) == sorted(full) and len(full) > 50


def test_words_found_in_batches_are_those_of_the_text(monkeypatch):
    import numpy as np

    rng = random.Random(3)
    texts = ["".join(rng.choice("abÀéİß😀𝒳_9 .,\u2019\u3000\n") for _ in range(n)) for n in (0, 1, 5, 40, 300, 4000)] + ["x" * 700, "Ab ab AB"]
    for piece in (1 << 20, 512):
        monkeypatch.setattr(d, "PIECE", piece)
        many = [0] * len(texts)
        numbers = [[] for _ in texts]
        for points, spans in d._pieces(texts):
            assert len(points) <= piece
            got, starts = d.word_numbers(points)
            at = np.searchsorted([b for _, b in spans], starts, "right") - 1
            for x, k in zip(got.tolist(), at.tolist(), strict=True):
                numbers[spans[k][0]].append(x)
                many[spans[k][0]] += 1
        words = [d.words_of(t) for t in texts]
        cut = piece == 512  # a word longer than a piece is cut there
        assert all(len(n) == len(w) or cut and "x" in t for n, w, t in zip(numbers, words, texts, strict=True))
        seen = {}
        for n, w, t in zip(numbers, words, texts, strict=True):
            if len(n) == len(w):
                for x, y in zip(n, w, strict=True):
                    assert seen.setdefault(y, x) == x
        assert len(set(seen.values())) == len(seen)
    assert d.words_of("Ab ab AB.") == ["ab", "ab", "ab"] and d.words_of(None) == []


def test_leaks_in_a_long_text_cut_into_pieces(spark, documents, monkeypatch):
    items, rows, _ = fixture()
    text = " ".join(t for _, t in rows) + " " + items[3][1] + " " + " ".join(t for _, t in rows[:30])
    whole = {(r.doc_id, r.item_id) for r in d.contamination(documents([(1, text)]), spark.createDataFrame(items, "item_id long, text string")).collect()}
    monkeypatch.setattr(d, "PIECE", 3000)
    index = d.Index(items, {w: 1 for _, t in items for w in d.words_of(t)}, 70, 20.0)
    assert {(1, x["item_id"]) for x in index.leaks([text, None, ""], 0.6, 0.6, 0.8, 5)[0]} >= whole - {(1, None)} and (1, 3) in whole


def test_more_shards_than_a_pass(spark, documents, monkeypatch):
    items, rows, leaks = fixture()
    tests = spark.createDataFrame(items + [(None, "nobody knows this one. but it is here")], "item_id long, text string")
    monkeypatch.setattr(d, "SHARDS_A_PASS", 2)
    got = {(r.doc_id, r.item_id) for r in d.contamination(documents(rows), tests, shard_items=12).collect()}
    assert got == leaks


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    items, rows, _ = fixture()
    assert d.contamination(documents(rows), none).collect() == []
    assert d.contamination(documents([]), spark.createDataFrame(items, "item_id long, text string")).collect() == []
