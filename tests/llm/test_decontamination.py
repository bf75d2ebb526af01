import itertools
import random

from rowloom.llm import decontamination
from rowloom.llm.decontamination import AGREE, MASKS, SPAN, find_leaks, leaks_by_document, without_leaks
from tests.llm.fixtures import empty_docs, odd_docs, odd_texts, sentence


def test_masks_find_any_two_substitutions():
    for bad in itertools.combinations(range(SPAN), SPAN - AGREE):
        assert any(
            all(s + k not in bad for k, on in enumerate(mask) if on == "1")
            for mask in MASKS
            for s in range(SPAN - len(mask) + 1)
        )


def brute(docs, items):
    """Every alignment of every item, word by word."""
    out = set()
    for d, text in docs:
        w = text.lower().split()
        for i, item in items:
            x = item.lower().split()
            if len(x) < len(MASKS[0]):
                continue
            need = -(-min(len(x), SPAN) * AGREE // SPAN)
            for shift in range(-len(x), len(w)):
                same = [0 <= shift + k < len(w) and w[shift + k] == x[k] for k in range(len(x))]
                if any(sum(same[a : a + SPAN]) >= need for a in range(max(1, len(x) - SPAN + 1))):
                    out.add((d, i))
                    break
    return out


def test_substitutions(spark):
    rng = random.Random(4)
    items = [(i, sentence(rng, n)) for i, n in enumerate([40, 14, 12, 9, 8, 25])]
    docs = []
    for d in range(60):
        words = rng.choice(items)[1].split()
        if d % 3 == 0:
            words = words[: rng.randint(5, len(words))]
        for at in rng.sample(range(len(words)), min(len(words), d % 5)):
            words[at] = "other"
        docs.append((d, sentence(rng, rng.randint(0, 30)) + " " + " ".join(words) + " " + sentence(rng, 10)))
    found = find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    got, want = {(r.doc_id, r.item_id) for r in found}, brute(docs, items)
    # Seeds are sure for two substitutions in twelve words; nothing is found that the alignment does not confirm.
    long = {i for i, t in items if len(t.split()) >= SPAN}
    assert got <= want and {x for x in want if x[1] in long} <= got and len(got) > 25


def test_case_and_punctuation(spark):
    rng = random.Random(6)
    item = sentence(rng, 20)
    docs = spark.createDataFrame([(1, item.upper().replace(" ", ", ")), (2, sentence(rng, 50))], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    assert [(r.doc_id, r.items) for r in leaks_by_document(docs, bench).collect()] == [(1, [7])]


def test_both_routes_agree(spark, monkeypatch):
    """Beyond the bound seeds are shuffled with the words around them; passages at both ends of a text are found."""
    rng = random.Random(8)
    items = [(i, sentence(rng, 30)) for i in range(6)]
    docs = []
    for d in range(80):
        passage = rng.choice(items)[1].split()
        cut = rng.randint(0, 18)
        words = passage[cut : cut + rng.randint(10, 20)]
        words[rng.randrange(len(words))] = "other"
        docs.append((d % 70, " ".join([*sentence(rng, d % 7).split(), *words, *sentence(rng, d % 5).split()])))
    given = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    broadcast = sorted(map(tuple, find_leaks(*given).collect()))
    rest = sorted(map(tuple, without_leaks(*given).collect()))
    monkeypatch.setattr(decontamination, "SEED_ROWS", 0)
    assert sorted(map(tuple, find_leaks(*given).collect())) == broadcast and len(broadcast) > 40
    assert sorted(map(tuple, without_leaks(*given).collect())) == rest


def test_only_the_leaking_text_of_an_id_goes(spark):
    rng = random.Random(9)
    item, clean = sentence(rng, 30), sentence(rng, 30)
    rows = [(None, item), (None, clean), (1, clean), (1, f"{clean} {item}"), (2, clean), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = without_leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    want = [(None, clean), (1, clean), (2, clean), (None, None)]
    assert sorted(map(tuple, left), key=repr) == sorted(want, key=repr)


def test_odd_rows(spark):
    passage = next(t for d, t, *_ in odd_texts() if d == 8)[-150:]
    bench = spark.createDataFrame([(1, passage), (1, passage), (2, None), (3, ""), (None, passage)], "item_id long, text string")
    found = {r.doc_id: r.n_items for r in leaks_by_document(odd_docs(spark), bench).collect()}
    assert found == {8: 2}
    assert len(without_leaks(odd_docs(spark), bench).collect()) == len(odd_texts()) - 1
    assert find_leaks(empty_docs(spark), bench).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert len(without_leaks(odd_docs(spark), none).collect()) == len(odd_texts())
