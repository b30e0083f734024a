"""The filter audit against the filters applied one after the other, and tries against plain sets."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

from levyflow.llm import filter_audit as audit
from levyflow.llm.filter_audit import RadixTrie, failure_masks
from tests.llm.tables import DOC_SCHEMA, no_documents, odd_documents, prose, with_clashes


def fails(name, key, text, smallest):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": any(c in "#$%&*|" for c in text),
        "E": key is not None and key > smallest.get(text, key),
    }[name]


def brute(rows, labels):
    smallest = {}
    for key, text, _ in rows:
        if key is not None:
            smallest[text or ""] = min(key, smallest.get(text or "", key))
    good, toxic = ({k for k, *v in labels if k is not None and v[i] == 1} for i in (0, 1))
    own = defaultdict(list)
    for key, text, part in rows:
        own[part or ""].append((key, {n for n in "ABCDE" if fails(n, key, text or "", smallest)}))
    out, shapley = [], Counter()
    for part, docs in own.items():
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, name in enumerate(order, 1):
                here = [d for d in left if name in d[1]]
                kept = [d for d in left if name not in d[1]]
                shapley[part, name] += len(here)
                out.append((part, order, step, len(kept), len(here), sum(name in f for _, f in docs) - len(here),
                            sum(f == {name} for _, f in docs), sum(k in good for k, _ in here), sum(k in toxic for k, _ in here)))
                left = kept
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def test_every_order_and_step(spark):
    rng = random.Random(2)
    texts = [prose(rng.choice([10, 49, 50, 51, 400]), rng.randrange(12)) + rng.choice(["", " 100%", " ABCDEFGHIJ" * 9]) for _ in range(60)]
    rows = [(rng.randrange(50), t, rng.choice(["a", "b", "", None])) for t in texts]
    rows += [(None, texts[0], "a"), (None, None, None), (60, None, "b"), (61, "", "a"), (3, texts[0], "c"), (3, texts[0], "c")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(40)] + [(1, 1, 1), (None, 1, 1)]
    docs = with_clashes(spark.createDataFrame([(k, t, "en", s, 0) for k, t, s in rows], DOC_SCHEMA).repartition(5))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.filter_audit(docs, with_clashes(marks))
    assert [tuple(r) for r in sorted(got.collect())] == brute(rows, labels)


def test_shared_prefixes_are_lengthened(spark, monkeypatch):
    monkeypatch.setattr(audit, "PREFIX_BYTES", 500)
    monkeypatch.setattr(audit, "RANGE_BYTES", 2000)
    base, rng = prose(300, 5), random.Random(3)
    texts = [base + f" tail {rng.randrange(20)}" for _ in range(80)] + [base] * 20 + [base[:100], base[:8], base[:64], base[:63]] * 3
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = Counter(r.doc for r in failure_masks(spark.createDataFrame(rows, DOC_SCHEMA).repartition(9)).collect() if r["mask"] & audit.COPY)
    first = {t: texts.index(t) for t in texts}
    assert got == Counter(i for i, t in enumerate(texts) if first[t] < i)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    masks = failure_masks(docs).collect()
    assert sum(r.n for r in masks) == docs.count()
    # The text of 2 is that of 1, and 5 is empty like the null text of 4.
    assert {r.doc: r.n for r in masks if r["mask"] & audit.COPY} == {2: 2, 5: 1}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.filter_audit(no_documents(spark), empty).count() == 0


def test_tries_hold_texts_once():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(12))).encode() for _ in range(400)] + [b"", b"a" * 9000, b"a" * 9001]
    trie, want = RadixTrie(), defaultdict(list)
    for key, text in enumerate(texts):
        trie.insert(text, -key, (key, text))
        want[text].append((key, text))
    assert sorted(trie.terminals()) == sorted((-max(k for k, _ in own), own) for own in want.values())
