import random
from itertools import combinations

import xxhash
from llm_fixtures import SF_SMALL, clashing, docs_of  # noqa: F401
from pyspark.sql import functions as F

from mortar.llm import simhash, words
from mortar.llm.queries import QUERIES


def brute_fingerprint(text):
    w = [x.lower() for x in (text or "").encode().split()]
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    ones = [sum((xxhash.xxh64_intdigest(s, 42) >> b) & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b, n in enumerate(ones) if 2 * n > len(shingles))


def brute_components(fps, radius=2):
    """fps: list of (id, fingerprint); component of each place by search over all pairs."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(fps)), 2):
        if bin(fps[a][1] ^ fps[b][1]).count("1") <= radius:
            root[find(a)] = find(b)
    least = {}
    for i, (name, _) in enumerate(fps):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return [(name, fp, least.get(find(i))) for i, (name, fp) in enumerate(fps)]


def test_masks_cover_every_pair_of_positions():
    masks = simhash.covering_masks(2)
    assert len(masks) == 7
    for a, b in combinations(range(64), 2):
        assert any(not (m >> a) & 1 and not (m >> b) & 1 for m in masks)
    four = simhash.covering_masks(4)
    rnd = random.Random(0)
    for _ in range(500):
        at = rnd.sample(range(64), 4)
        assert any(all(not (m >> i) & 1 for i in at) for m in four)


def test_components_against_brute_force(spark):
    rnd = random.Random(4)
    fps = [0, 1, 3, 7, 15, (1 << 64) - 1, 1 << 63]
    for _ in range(25):
        x = rnd.getrandbits(64)
        fps.append(x)
        for _ in range(rnd.randint(0, 8)):  # chains: each one or two bits from the one before
            x ^= 1 << rnd.randrange(64)
            x ^= (1 << rnd.randrange(64)) * rnd.randint(0, 1)
            fps.append(x)
    for _ in range(60):  # values three bits apart share buckets without being linked
        a, b, c = rnd.sample(range(64), 3)
        fps.append((1 << a | 1 << b | 1 << c) ^ 0xAAAAAAAAAAAAAAAA)
    rows = [(rnd.randint(0, 5000), f) for f in fps] + [(None, fps[9]), (6000, fps[3]), (6000, fps[3]), (None, 0x123456789ABCDEF)]
    df = spark.createDataFrame([(i, simhash.signed(f)) for i, f in rows], "doc_id long, fp long").repartition(4)
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_groups(df).collect()), key=str)
    assert got == sorted(brute_components(rows), key=str)


def test_a_large_bucket_gives_no_pairs(spark):
    """All values of 12 bits agree elsewhere: one component, and few links."""
    df = spark.range(1 << 12).select(F.col("id").alias("doc_id"), F.col("id").alias("fp"))
    found = simhash.links(df)
    assert found.count() < 40 * (1 << 12)
    assert simhash.near_groups(df).select("component_id").distinct().collect()[0].component_id == 0


def test_long_chain(spark):
    """Gray codes: a path of 512 nodes is one component."""
    edges = spark.range(511).select((F.col("id") * 7 % 512).alias("a"), ((F.col("id") + 1) * 7 % 512).alias("b"))
    got = simhash.connect(edges).collect()
    assert len(got) == 512 and {r.root for r in got} == {0}


def test_a_star_is_met_in_many_places(spark):
    """A centre with 20,000 neighbours: one component, its way back dealt over all salts."""
    n = 20_000
    edges = spark.range(1, n + 1).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b"))
    assert simhash.connect(edges).groupBy("root").count().collect() == [(0, n + 1)]
    middle = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    places = middle.groupBy(simhash.salt_of([F.col("b")], simhash.SALTS)).count().collect()
    assert len(places) == simhash.SALTS and max(r["count"] for r in places) < 2 * n / simhash.SALTS
    got = simhash.with_least(middle).agg(F.count("*"), F.min("m"), F.max("m")).first()
    assert tuple(got) == (n, 1, 1)


def test_null_and_repeated_ids_spread(spark, monkeypatch):
    """Copies without an id, or with one id, are not one salt; each row comes out."""
    written = []
    write = simhash.write_scratch
    monkeypatch.setattr(simhash, "write_scratch", lambda df, name: written.append(write(df, name)) or written[-1])
    df = spark.range(6000).select(F.when(F.col("id") % 2 == 0, 7).cast("long").alias("doc_id"), F.lit(5).cast("long").alias("fp"))
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_groups(df).collect()), key=str)
    assert got == [(7, 7)] * 3000 + [(None, 7)] * 3000
    places = written[0].groupBy("_salt").count().collect()
    assert len(places) == simhash.SALTS and max(r["count"] for r in places) < 2 * 6000 / simhash.SALTS


def test_rounds_are_deleted(spark):
    import glob

    from mortar.session import checkpoint_dir

    here = checkpoint_dir(spark).removeprefix("file:") + "/llm-links-*"
    before = set(glob.glob(here))
    edges = spark.range(100).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert simhash.connect(edges).count() == 101
    assert len(set(glob.glob(here)) - before) == 1


TEXTS = ["", None, " \n", "one", "One  two", "one two three", "ONE two\tthree", "a b c d e f g h", "É a b c", "x " * 400, "the cat sat on the mat " * 30]


def test_fingerprints(docs_of, clashing, monkeypatch):
    rnd = random.Random(8)
    rows = list(enumerate(TEXTS)) + [(50 + i, " ".join(rnd.choice("abcdefghij") * 3 for _ in range(rnd.randint(1, 90)))) for i in range(30)] + [(None, "no id"), (50, "twice"), (50, "twice")]
    expect = sorted(((i, brute_fingerprint(t)) for i, t in rows), key=str)
    df = clashing(docs_of(rows), "fp", "_salt", "_kept", "component_id")
    for block in (1 << 21, 64):
        monkeypatch.setattr(words.word_blocks, "__defaults__", (block,))
        assert sorted(((r.doc_id, r.fp % (1 << 64)) for r in simhash.fingerprints(df).collect()), key=str) == expect


def test_first_words_that_fill_a_block(docs_of, monkeypatch):
    """One or two words before the first border, or white space after them, are not the whole text."""
    begins = ["x" * 200, "x " + "y" * 200, "x" + " " * 200, "x y" + "\n" * 200, " " * 200, " " * 200 + "x"]
    rows = list(enumerate(b + rest for b in begins for rest in ("", " a", " a b c d", " a b" + " " * 200, " a b c d" * 60, " " * 200 + "q r s t")))
    monkeypatch.setattr(words.word_blocks, "__defaults__", (64,))
    got = {r.doc_id: r.fp % (1 << 64) for r in simhash.fingerprints(docs_of(rows)).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in rows}


def test_representatives(docs_of, clashing):
    rows = [(5, "a b c d"), (3, "A B  c d"), (9, "quite another text altogether"), (7, None), (8, ""), (None, "a b c d")]
    df = clashing(docs_of(rows), "fp", "_salt", "_kept", "component_id")
    kept = simhash.keep_representatives(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 9]
    assert simhash.keep_representatives(docs_of([])).count() == 0


def test_one_representative_whatever_the_ids(docs_of, clashing):
    """Null ids, repeated ids and repeated rows: one row of each component stays."""
    near, other, third = "a b c d", "quite another text altogether", "words of a third kind here"
    given = [
        ([(None, near), (None, near.upper()), (None, "A b c D")], [None]),  # copies without an id
        ([(None, near), (None, near), (None, other)], [None, None]),  # two components without ids
        ([(None, near), (4, near), (None, other)], [4, None]),  # the copy with an id stays
        ([(3, near), (3, near.upper()), (3, near), (5, near)], [3]),  # copies that share an id, equal rows among them
        ([(3, near), (3, other), (2, other), (3, third)], [2, 3, 3]),  # one id, several texts
    ]
    for rows, expect in given:
        df = clashing(docs_of(rows), "_row", "_text", "_hash_a", "component_id")
        kept = simhash.keep_representatives(df)
        assert kept.columns == df.columns
        found = kept.collect()
        assert sorted((r.doc_id for r in found), key=str) == sorted(expect, key=str), rows
        assert len({brute_fingerprint(r.text) for r in found}) == len({brute_fingerprint(t) for _, t in rows}) == len(found)


def test_query(spark):
    docs = [(r.doc_id, brute_fingerprint(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in QUERIES["op8_simhash"](spark, SF_SMALL).collect())
    assert got == sorted(brute_components(docs))
