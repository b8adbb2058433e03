from strata.llm import decontaminate

ITEM = "A train leaves Boston at 9 with 120 people and travels 45 km before it stops for 10 minutes near the old bridge"


def items(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id bigint, text string, row int")


def found(spark, docs, rows, bench=((7, ITEM),)):
    return {(r.id, r["item"]) for r in decontaminate.leaks(docs(rows), items(spark, bench)).collect()}


def test_copies_and_new_parameters(spark, docs):
    other = ITEM.replace("Boston", "Madrid").replace("120", "2,500").replace("45 km", "31 miles").replace("10", "25")
    rows = [
        (1, "Some text before. " + ITEM + ". And some after."), (2, ITEM.upper().replace(" ", "  ")), (3, "we read " + other),
        (4, "A train leaves and nothing else of it is here, only other words about other things"), (5, None), (6, ""),
        (8, ITEM), (8, ITEM),
    ]
    # In a text of capitals every word reads as a name, so it has other templates and is not found.
    assert found(spark, docs, rows) == {(1, 7), (3, 7), (8, 7)}


def test_slots_that_do_not_fit(spark, docs):
    item = " ".join(f"step {n} adds 5 to row 6 and" for n in ("one", "two", "three", "four", "five"))
    fits = item.replace("5", "8").replace("6", "9")
    parts = item.split("step")
    clash = "step".join(p.replace("5", str(10 + k)).replace("6", str(30 + k % 2)) for k, p in enumerate(parts))
    got = found(spark, docs, [(1, item), (2, fits), (3, clash)], [(1, item)])
    assert got == {(1, 1), (2, 1)}


def test_short_items_and_empty_tables(spark, docs):
    assert found(spark, docs, [(1, "one two three four")], [(1, "one two three four"), (2, None)]) == set()
    assert found(spark, docs, [(1, "so one two three four five ends")], [(1, "one two three four five")]) == {(1, 1)}
    assert found(spark, docs, [], [(1, ITEM)]) == set()
    assert found(spark, docs, [(1, ITEM)], []) == set()


def test_like_brute_force(spark, docs):
    import random

    rnd = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    bench = [(k, " ".join(rnd.choices(words, k=rnd.randint(8, 30)))) for k in range(25)]
    rows = [(k, " ".join([*rnd.choices(words, k=20), rnd.choice(bench)[1], *rnd.choices(words, k=9)])) for k in range(40)]
    rows += [(100 + k, " ".join(bench[k][1].split()[: 4 + k])) for k in range(25)] + [(300, " ".join(rnd.choices(words, k=2000)))]
    grams = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
    share = lambda t, b: sum(tuple(b.split()[i : i + 5]) in grams(t) for i in range(len(b.split()) - 4)) / (len(b.split()) - 4)
    assert found(spark, docs, rows, bench) == {(i, k) for i, t in rows for k, b in bench if share(t, b) >= 0.5}


def test_documents_without_leaks(spark, docs):
    frame = docs([(1, ITEM), (2, "clean words only in this one"), (3, None)])
    kept = decontaminate.without_leaks(frame, items(spark, [(7, ITEM)]))
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_each_place_is_judged_alone(spark, docs):
    other = ITEM.replace("Boston", "Madrid").replace("9", "7").replace("120", "80").replace("45", "31").replace("10", "25")
    chance = "it leaves Lisbon at 8 with 99 people and travels 12 km before it stops for 3 minutes near the sea"
    filler = " ".join(f"plain{i}" for i in range(3000))
    listed = "the winning numbers of this week are 3 14 15 92 65 35 89 79 32 38 46 and no more"
    steps = "then " + " ".join(f"add {k} to row {k + 20} and" for k in range(9)) + " stop"
    rows = [
        (1, f"{ITEM} and later {other}"), (2, f"{chance} {filler} {ITEM}"), (3, "We read that " + listed), (4, "we say " + steps),
    ]
    assert found(spark, docs, rows, [(7, ITEM), (8, listed), (9, steps)]) >= {(1, 7), (2, 7), (3, 8), (4, 9)}
    clash = "then " + " ".join(f"add {k % 2} to row {k + 20} and" for k in range(9)) + " stop"
    assert (5, 9) not in found(spark, docs, [(5, clash)], [(9, steps)])
