import re

import pytest
import xxhash

from levyflow.llm.simhash import fingerprint, first_of_groups, simhash_components
from tests.llm.tables import no_documents, odd_documents, prose


def plain_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    near = [[j for j, q in enumerate(prints) if (p ^ q).bit_count() <= 3] for p in prints]
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = set(near[todo.pop()]) - seen
            seen |= new
            todo += new
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((key, f"{prints[i]:016x}", min(keys, default=None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("text", [None, "", " \n", "A", "a B", "Über GRÖSSE c d", prose(3000, 9), "a\x0bb\x0cc\x1cd\xa0e f"])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_spark_hashes_shingles_alike(spark):
    """The fingerprint's hash is the engine's own, should anyone check it in SQL."""
    assert spark.sql("SELECT xxhash64('a b c') AS h").first()["h"] % 2**64 == xxhash.xxh64_intdigest("a b c", 42)


@pytest.mark.parametrize("options", [{}, {"chunk": 2}, {"blocks": 4}])
def test_same_components_as_all_pairs(spark, options):
    docs = odd_documents(spark)
    base = prose(400, 8).split()
    copies = []
    for i in range(40):  # a chain of copies that drift apart
        base[i * 7 % 400] = f"w{i}"
        copies.append((100 + i, " ".join(base)))
    docs = docs.select("doc_id", "text", "key").union(spark.createDataFrame([(*c, "k") for c in copies], "a long, b string, c string"))
    got = [tuple(r) for r in simhash_components(docs, **options).collect()]
    assert sorted(got, key=repr) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_one_document_of_each_group_stays(spark):
    docs = odd_documents(spark)
    groups = {r[0]: r[2] for r in brute([(r.doc_id, r.text) for r in docs.collect()])}
    kept = first_of_groups(docs).collect()
    assert kept[0].__fields__ == docs.columns
    assert {r.doc_id for r in kept} == {k for k, c in groups.items() if k is None or k == c}


def test_no_rows(spark):
    assert simhash_components(no_documents(spark)).count() == 0
    assert first_of_groups(no_documents(spark)).count() == 0


def test_key_stays_in_its_place(spark):
    docs = spark.createDataFrame([("a b c", 2, 1), ("a b c", 1, 2), (None, None, 3)], "text string, doc_id long, component_id int")
    kept = first_of_groups(docs)
    assert kept.columns == docs.columns and sorted(map(repr, map(tuple, kept.collect()))) == [repr(("a b c", 1, 2)), repr((None, None, 3))]
