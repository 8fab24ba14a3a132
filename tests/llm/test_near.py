import random
from collections import Counter, defaultdict

import numpy as np

from pyspark.sql import functions as F

from lectio.llm import order_minhash as O
from lectio.llm.components import components


def lcs(a, b):
    """Longest common subsequence, by the full table."""
    row = [0] * (len(b) + 1)
    for x in a:
        left = 0
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], left + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_matches_the_full_table():
    rnd = random.Random(2)
    for _ in range(150):
        a = [rnd.choice(["u", "v", *map(str, range(60))]) for _ in range(rnd.randrange(5, 90))]
        b = [w for w in a for w in ([w] * (rnd.random() > .04) + ["new"] * (rnd.random() < .03))]
        if rnd.random() < .2:
            b = b[len(b) // 2:] + b[:len(b) // 2]
        la, lb = (O.shingles([w.encode() for w in x])[1] for x in (a, b))
        if not len(la) or not len(lb):
            continue
        m = lcs(la.tolist(), lb.tolist())
        want = m / (len(la) + len(lb) - m)
        got = O.aligned(la, lb)
        assert (got >= 0.8) == (want >= 0.8) and (want < 0.8 or got == want)


def test_repeated_shingles_are_told_apart():
    _, labelled = O.shingles(b"a b c d e a b c d e a b c d e".split())
    assert len(np.unique(labelled)) == len(labelled) == 11
    assert len(O.shingles([b"x"])[0]) == 1 and len(O.shingles([])[0]) == 0


def test_sketches_agree_as_predicted():
    """At similarity 0.8 almost every pair agrees on a sketch, and a text
    with its halves swapped on far fewer than one in order."""
    rnd = random.Random(4)
    missed = 0
    for n in [8, 12, 20, 60, 300] * 12:
        words = [b"%d" % rnd.randrange(10**9) for _ in range(n + 4)]
        longer = words + [b"%d" % rnd.randrange(10**9) for _ in range(n // 4)]
        missed += not set(O.sketches(words)) & set(O.sketches(longer))
    assert missed <= 1
    plain, labelled = O.shingles([b"%d" % i for i in range(304)])
    turned = O.shingles([b"%d" % i for i in [*range(152, 304), *range(152)]])
    same = sum(x == y for x, y in zip(O.sketch(plain, labelled, 200, 5, 1), O.sketch(*turned, 200, 5, 1), strict=True))
    assert same < 60  # the sets are nearly equal: without order about 180 agree


def classes_by_brute_force(rows):
    label = {k: O.shingles(O.words_of(t))[1] for k, (_, t) in enumerate(rows)}
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in label:
        for b in range(a):
            if O.aligned(label[a], label[b]) >= O.THRESHOLD:
                up[find(a)] = find(b)
    groups = defaultdict(list)
    for k in label:
        groups[find(k)].append(k)
    return groups.values()


def check(rows, got):
    want = Counter()
    for group in classes_by_brute_force(rows):
        ids = [rows[k][0] for k in group]
        first = min((i for i in ids if i is not None), default=None)
        want.update((i, first, len(ids)) for i in ids)
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(classes_by_brute_force(rows)) and all(r.doc_id == r.class_id for r in kept)


def test_odd_rows(odd_docs, no_docs):
    check([(r.doc_id, r.text) for r in odd_docs.collect()], O.near_duplicates(odd_docs).collect())
    assert O.near_duplicates(no_docs).count() == 0
    kept = O.drop_near_copies(odd_docs)
    assert kept.schema == odd_docs.schema
    assert kept.count() == O.near_duplicates(odd_docs).where("kept").count()


def test_groups_of_copies_of_an_original(spark):
    """Copies that are near their original but not each other, in a group
    larger than a small band, and unrelated texts that share a passage."""
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randrange(10**9)}"
    rows = []
    for size in (3, 40):
        original = [word() for _ in range(120)]
        rows.append(original)
        for _ in range(size):
            copy = list(original)
            for at in rnd.sample(range(0, 116, 6), 2):
                copy[at] = word()
            rows.append(copy)
    passage = [word() for _ in range(30)]
    rows += [[word() for _ in range(40)] + passage + [word() for _ in range(40)] for _ in range(40)]
    rnd.shuffle(rows)
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    check(rows, O.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_template_whose_links_avoid_the_first_hubs(spark):
    """A band of 160 texts from one template, below the threshold to each
    other but for pairs that share one of their slots."""
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(10**9)}"
    template = [word() for _ in range(200)]
    rows = []
    for _ in range(80):
        slots = [word() for _ in range(5)]
        for _ in range(2):
            text = list(template)
            for k, at in enumerate(range(10, 190, 40)):
                text[at] = slots[k] if k < 1 else word()
            rows.append(text)
    rnd.shuffle(rows)
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    assert len(classes_by_brute_force(rows)) == 80
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, O.near_duplicates(df).collect())
    check(rows, O.near_duplicates(df, hub_rounds=0).collect())


def test_reordered_texts_are_pruned_before_they_are_fetched(spark):
    """Catalogues of the same passages in other orders share all shingles;
    few pairs are aligned, and none that links is lost."""
    rnd = random.Random(12)
    passages = [[f"p{i}w{j}" for j in range(18)] for i in range(14)]
    rows = []
    for _ in range(240):
        rnd.shuffle(passages)
        rows.append([w for p in passages for w in p])
    for at in range(0, 240, 12):  # and some near copies
        copy = list(rows[at])
        copy[100] = "other"
        rows.append(copy)
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, "row long, text string")
    pairs = {(r.a, r.b) for r in O.prefix_pairs(df.select("row", F.col("row").alias("class")), df).collect()}
    labels = [O.shingles(O.words_of(t))[1] for _, t in rows]
    links = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if O.aligned(labels[i], labels[j]) >= O.THRESHOLD}
    assert links <= pairs and len(links) >= 20
    assert len(pairs) <= 3 * len(rows)  # of 33,670 that share all their passages


def test_components_against_union_find(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, i) for i in range(501, 560)]
    edges += [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(90)] + [(7, 7), (None, 3)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in up if find(x) != x}
