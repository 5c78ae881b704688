import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tierline.llm import simhash
from tierline.llm.components import connected_components


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    rng = random.Random(2)
    for text in ["", "  ", "One", "one TWO", "a b c", "É É é  x", "w " * 70_000,
                 *(" ".join(rng.choices("abcDEF", k=rng.randint(1, 40))) for _ in range(50))]:
        assert simhash.fingerprint(text) & (2 ** 64 - 1) == plain_fingerprint(text)


def test_groups_against_brute_force(documents, by_id):
    rng = random.Random(3)
    base = [[rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(rng.randint(1, 400))] for _ in range(25)]
    texts = [None, "", " ", "a"]
    for words in base:
        for _ in range(6):
            changed = list(words)
            for _ in range(rng.choice([0, 0, 1, 2])):
                changed[rng.randrange(len(changed))] = "new"
            texts.append(" ".join(changed))
    found = by_id(simhash.near_duplicates(documents(*texts)))
    prints = [plain_fingerprint(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    groups = components(range(len(texts)), near)
    assert {d: tuple(r)[1:] for d, r in found.items()} == {i: (f"{prints[i]:016x}", groups[i]) for i in range(len(texts))}
    assert any(prints[i] != prints[j] for i, j in near)


def _distinct(spark, prints):
    return spark.createDataFrame([(int(np.uint64(p).astype(np.int64)), i) for i, p in enumerate(prints)], "print long, least long")


def test_tiles_find_every_link_in_blocks_of_any_size(spark):
    rng = random.Random(4)
    prints = list({p for c in (rng.getrandbits(64) for _ in range(40))
                   for p in (c, *(c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(8)))})
    near = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    want = components(range(len(prints)), near)
    for block in (3, 2048):
        linked = [(r.a, r.b) for r in simhash.links(_distinct(spark, prints), block=block).collect()]
        assert components(range(len(prints)), linked) == want


def test_a_large_group_of_near_copies_is_a_forest_not_all_pairs(spark):
    prints = [0, *((1 << i) for i in range(64))]  # all within two bits of each other
    assert simhash.links(_distinct(spark, prints)).count() < 5 * len(prints)


def test_tiles_skip_what_is_beyond_the_radius():
    assert len(simhash.tile_offsets(2)) == 21 and 0 in simhash.tile_offsets(2)


def test_ids_that_repeat_or_are_missing(documents):
    a, b = "x y z w", "p q r s t"
    docs = documents((9, a), (9, b), (4, a), (7, b), (None, a), (2, "unlike the others"))
    found = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in found if r.doc_id) == [(2, 2), (4, 4), (7, 4), (9, 4), (9, 4)]
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    stay = simhash.deduplicate(docs.withColumns({c: F.lit(0) for c in ("print", "least", "tile", "node", "component")}))
    assert sorted(str(r.doc_id) for r in stay.collect()) == ["2", "4", "7", "None"]


def test_empty_table(documents):
    assert simhash.near_duplicates(documents()).count() == 0 and simhash.deduplicate(documents()).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(200, 300)]
    linked = chain + star + [(500, 500), (None, 3), (501, 502), (502, 501), (501, 502)]
    rng.shuffle(linked)
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(linked, "a long, b long")).collect()}
    whole = [(a, b) for a, b in linked if a is not None and a != b]
    assert found == components({n for e in whole for n in e}, whole)


def _words(rng, n):
    return ["".join(rng.choices("abcdefghijklm", k=6)) for _ in range(n)]


def edited_texts(rng, groups, copies):
    """Long texts and copies of them with a word or two changed."""
    texts = []
    for _ in range(groups):
        base = _words(rng, rng.randint(300, 600))
        texts.append(" ".join(base))
        for _ in range(copies):
            changed = list(base)
            for _ in range(rng.choice([1, 1, 2])):
                changed[rng.randrange(len(changed))] = "changed"
            texts.append(" ".join(changed))
    return texts


def test_removal_against_brute_force(documents):
    rng = random.Random(21)
    texts = [*edited_texts(rng, 25, 6), *(" ".join(_words(rng, rng.randint(1, 300))) for _ in range(60)), None, "", "a b", "a c"]
    texts += [texts[0].upper(), texts[3]]
    rng.shuffle(texts)
    prints = [plain_fingerprint(t) for t in texts]
    near = [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    stay = sorted(r.doc_id for r in simhash.deduplicate(documents(*texts)).collect())
    assert stay == sorted(set(components(range(len(texts)), near).values())) and len(stay) < len(texts)


def test_removal_returns_every_other_column_as_it_is(documents):
    docs = documents("a b c d", "a b c d", "e f").withColumns(
        {c: F.lit(c) for c in ("row_number", "Row_Number_", "__row", "row", "print", "least", "best", "id", "component", "group")})
    stay = simhash.deduplicate(docs)
    assert stay.columns == docs.columns
    assert sorted(map(str, stay.collect())) == sorted(map(str, docs.filter("doc_id <> 1").collect()))


def test_a_large_group_of_copies_leaves_one(documents):
    texts = ["one two three four five"] * 3000 + ["quite another text"]
    assert sorted(r.doc_id for r in simhash.deduplicate(documents(*texts)).collect()) == [0, 3000]


def test_removal_goes_by_row_where_texts_share_an_id(documents):
    rng = random.Random(26)
    a, b, c = (" ".join(_words(rng, 100)) for _ in range(3))
    docs = documents((1, a), (7, a), (7, b), (8, b), (9, c), (9, c), (None, a), (None, a))
    assert sorted((str(r.doc_id), r.text) for r in simhash.deduplicate(docs).collect()) == sorted(
        [("1", a), ("7", b), ("9", c), ("None", a), ("None", a)])


def test_blocks_pair_within_the_radius_only(spark):
    """Templated texts far from each other: the block pairs follow the tiles, and no link is made."""
    rng = random.Random(27)
    base = _words(rng, 200)
    prints = set()
    while len(prints) < 400:
        copy = list(base)
        for k in rng.sample(range(200), 60):
            copy[k] = "".join(rng.choices("nopq", k=6))
        prints.add(plain_fingerprint(" ".join(copy)))
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 2]
    linked = simhash.links(_distinct(spark, list(prints))).count()
    assert linked <= len(near)
