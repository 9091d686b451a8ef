import random
import re

import pytest
import xxhash
from odd import none_of, odd_documents
from shedlake.llm.components import components
from shedlake.llm.simhash import BKTree, fingerprint_of, keep_first, near_links, simhash_dedup


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, near):
    """Class of each value under the closure of ``near``, by comparing all pairs."""
    of = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if near(a, b) and of[a] != of[b]:
                    of[a] = of[b] = min(of[a], of[b])
                    changed = True
    return of


def test_odd_rows_follow_the_contract(spark):
    docs = odd_documents(spark)
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    of = classes(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for doc_id, p in prints:
        if doc_id is not None:
            least[of[p]] = min(least.get(of[p], doc_id), doc_id)
    wanted = sorted(((d, f"{p:016x}", least.get(of[p])) for d, p in prints), key=str)
    assert sorted((tuple(r) for r in simhash_dedup(docs).collect()), key=str) == wanted


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(f"w{i * i % 101}" for i in range(500))
    whole = fingerprint_of(text)
    monkeypatch.setattr("shedlake.llm.simhash.CHUNK", 7)
    assert fingerprint_of(text) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("shard", [2, 5, 4096])
def test_links_connect_what_the_radius_connects(spark, shard):
    chosen = random.Random(shard)
    prints = set()
    for _ in range(15):
        middle = chosen.getrandbits(64)
        for _ in range(chosen.randrange(1, 12)):
            value = middle
            for _ in range(chosen.randrange(4)):
                value ^= 1 << chosen.randrange(64)
            prints.add(value)
    prints |= {0, 1, 2**64 - 1, 2**63}
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    frame = spark.createDataFrame([(signed(p),) for p in prints], "print long")
    found = {signed(p): signed(p) for p in prints}
    found.update({r.node: r.component for r in components(near_links(frame, 3, shard)).collect()})
    of = classes(sorted(prints), lambda a, b: (a ^ b).bit_count() <= 3)
    groups, wanted = {}, {}
    for p in prints:
        groups.setdefault(found[signed(p)], set()).add(p)
        wanted.setdefault(of[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_tree_finds_all_within_the_radius():
    chosen = random.Random(1)
    values = {chosen.getrandbits(12) for _ in range(400)}
    tree = BKTree()
    for v in values:
        tree.add(v)
    for probe in list(values)[:50] + [chosen.getrandbits(12) for _ in range(50)]:
        assert sorted(tree.near(probe, 3)) == sorted(v for v in values if (v ^ probe).bit_count() <= 3)


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(7, 7), (None, 3), (3, None), (160, 100)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys(range(5, 40), 5)}


def test_stage_keeps_one_of_each_group(spark):
    docs = odd_documents(spark)
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    rows = simhash_dedup(docs).collect()
    groups = {r.fingerprint: r.component_id for r in rows}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups.values()))


def test_empty_table(spark):
    docs = none_of(odd_documents(spark))
    assert simhash_dedup(docs).count() == 0 and keep_first(docs).count() == 0
