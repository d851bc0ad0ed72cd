import random

import pytest
import xxhash
from odd_docs import no_docs, odd_docs

from ombuds.llm import queries, simhash_groups
from ombuds.llm.components import components

SMALL = "/root/testdata/sf0.001"


def plain_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows, bits):
    """By comparing all pairs."""
    prints = [plain_fingerprint(text) for _, text in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            if (prints[x] ^ prints[y]).bit_count() <= bits:
                label[root(x)] = root(y)
    least = {}
    for x, (number, _) in enumerate(rows):
        if number is not None:
            least[root(x)] = min(least.get(root(x), number), number)
    return sorted((str(n), f"{p:016x}", str(least.get(root(x)))) for x, ((n, _), p) in enumerate(zip(rows, prints, strict=True)))


def got(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_query_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert got(queries.op9_simhash_groups(spark, SMALL)) == plain_components(docs, 2)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_dense_groups_against_all_pairs(spark, bits):
    random.seed(bits)
    base = [random.choice("abcdefghijklmnop") * 3 + str(i % 37) for i in range(120)]
    rows = []
    for number in range(150):
        words = list(base)
        for _ in range(random.randint(0, 2)):
            words[random.randrange(120)] = f"w{random.randint(0, 9)}"
        rows.append((number, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(simhash_groups.near_duplicates(docs, bits=bits)) == plain_components(rows, bits)


def test_links_are_all_pairs_within_the_distance(spark):
    random.seed(3)
    prints = set()
    for _ in range(20):
        center = random.getrandbits(64)
        for _ in range(12):
            prints.add(center ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 3))))
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = [tuple(row) for row in simhash_groups.links(frame, 2).collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd_docs(spark).collect()]
    assert got(simhash_groups.near_duplicates(odd_docs(spark))) == plain_components(rows, 2)
    assert simhash_groups.near_duplicates(no_docs(spark)).count() == 0


def test_one_row_of_each_group_stays(spark):
    docs = odd_docs(spark)
    kept = simhash_groups.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {c for _, _, c in plain_components([(r.doc_id, r.text) for r in docs.collect()], 2)}
    found = [r.doc_id for r in kept.collect()]
    assert sorted(map(str, found)) == sorted(groups)
    assert simhash_groups.keep_one(no_docs(spark)).count() == 0


def test_shingles_wider_than_the_text(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "ONE\x0btwo"), (3, "")], "doc_id long, text string")
    assert got(simhash_groups.near_duplicates(docs)) == plain_components([(1, "one two"), (2, "ONE\x0btwo"), (3, "")], 2)
    with pytest.raises(ValueError):
        simhash_groups.links(spark.createDataFrame([(1,)], "fp long"), 5)


def test_components_of_chain_star_and_loops(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    frame = spark.createDataFrame([*chain, *star, (500, 500), (None, 3), (41, 41)], "a long, b long")
    found = {row.node: row.component for row in components(frame).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {500: 500, 41: 41}
    assert components(frame.where("a is null")).count() == 0
