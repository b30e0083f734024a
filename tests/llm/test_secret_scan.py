import hashlib
import re

from levyflow.llm.secret_scan import find_secrets, mask_live, span_report
from tests.llm.tables import DOC_SCHEMA, no_documents, odd_documents, with_clashes

KEY = "9f8a7b6c5d4e3f2a1b0c9d8e7f6a5b4c"
ACCESS = "AKIA" + "Q7RT2ZX9LM4KPW0S"
TEXTS = [
    f'password = "{KEY}" and more', f"PassWd:'{KEY}', api-key=zzz", f"token={ACCESS}x {ACCESS}", "secret: short", "secret=abc12",
    f"api_key:{KEY} apikey = {KEY.upper()}", "ſecret=abcdefgh paſſword=abcdefg", f"é漢🙂 {KEY} AKIA{ACCESS}", "AKIA" * 9, "0123456789abcdef" * 2 + "g" + "f" * 23,
    "password=password=abcdefghij", "token == abcdefgh", "token:\n abcdefgh", "no secrets here", "", None, "ghp_" + "Ab1" * 12,
    "x" * 40_000 + f" secret={KEY}",
]


def brute_base(text):
    """The base kinds as their definition reads."""
    text, spans = text or "", []
    at = 0
    while at < len(text):
        name = next((n for n in ("password", "passwd", "secret", "token", "api_key", "apikey")
                     if text[at : at + len(n)].translate(LOWER) == n), None)
        m = name and re.compile(r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""").match(text, at + len(name))
        if not m:
            at += 1
            continue
        if len(m[1]) >= 6:
            spans.append((at, 0, m.end()))
        at = m.end()
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(spans)


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KINDS = ("assign", "access", "hex")


def test_base_spans(spark):
    rows = [(i, t, "en", f"src{i}", 0) for i, t in enumerate(TEXTS)]
    docs = with_clashes(spark.createDataFrame(rows, DOC_SCHEMA).repartition(4))
    got = {r.doc_id: r for r in span_report(find_secrets(docs)).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        base = brute_base(text)
        names = [f"{KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(b[1] == k for b in base) for k in range(3)], text
        assert got[i].base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert [s for s in got[i].spans.split(",") if s.split(":")[0] in KINDS] == names
    assert "provider:0:40" in got[16].spans


def test_whole_documents_against_the_definition(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in span_report(find_secrets(docs)).collect()}
    for r in docs.collect():
        names = [f"{KINDS[k]}:{s}:{e}" for s, k, e in brute_base(r.text)]
        assert got[r.doc_id].base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()


def test_who_owns_a_value_decides(spark):
    own, shared, blob = KEY, KEY[::-1], "Zq8Lw2Xc9Vb4Nm7As1Df6Gh3Jk5Po0Iu9Yt"
    rows = [(1, f"token={own}", "en", "s1", 0), (2, f"again token={own} {blob}", "en", "s1", 0)]
    rows += [(10 + i, f"secret={shared} secret=aaaaaaaaaa {blob[::-1]}", "en", f"s{i}", 0) for i in range(5)]
    found = {r.doc_id: r.hits for r in find_secrets(spark.createDataFrame(rows, DOC_SCHEMA)).collect()}
    assert {h.verdict for h in found[1]} == {"live"} and {h.owners for h in found[1]} == {1}
    assert [h.kind for h in found[2]] == [0, 2, 4]
    assert [(h.kind, h.verdict, h.owners) for h in found[10]] == [(0, "copied", 5), (2, "copied", 5), (0, "copied", 5)]
    masked = {r.doc_id: r.text for r in mask_live(spark.createDataFrame(rows, DOC_SCHEMA)).collect()}
    assert masked[2] == f"again token={'*' * len(own)} {'*' * len(blob)}"
    assert masked[10] == rows[2][1]


def test_masking_keeps_rows_and_columns(spark):
    docs = odd_documents(spark)
    out = mask_live(docs)
    assert out.columns == docs.columns and sorted(map(repr, out.collect())) == sorted(map(repr, docs.collect()))
    rows = [(1, f"é🙂 {KEY} {KEY}", "en", "s", 0)] * 2 + [(None, f"é🙂 {KEY} {KEY}", None, None, None)]
    hidden = "*" * len(KEY)
    assert [r.text for r in mask_live(spark.createDataFrame(rows, DOC_SCHEMA)).collect()] == [f"é🙂 {hidden} {hidden}"] * 3


def test_no_rows(spark):
    assert span_report(find_secrets(no_documents(spark))).count() == 0
    assert mask_live(no_documents(spark)).count() == 0


def test_columns_of_any_name_are_carried(spark):
    rows = [(1, f"token={KEY}", "a", "b", 1), (2, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __digest string, __spans string, source long")
    assert [tuple(r) for r in mask_live(docs).orderBy("doc_id").collect()] == [(1, f"token={'*' * len(KEY)}", "a", "b", 1), rows[1]]


def test_owners_and_repositories_are_told_apart(spark):
    """One owner's value stays live in any number of repositories, and one that many owners put into a
    single repository is a copied example."""
    own, shared = KEY, KEY[::-1]
    rows = [(i, f"token={own}", f"repo{i}", "me") for i in range(6)] + [(10 + i, f"token={shared}", "forum", f"user{i}") for i in range(6)]
    rows += [(20, f"token={own}", None, "me"), (21, f"token={shared}", "forum", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, repo string, owner string")
    found = {r.doc_id: r.hits for r in find_secrets(docs, repo="repo", owner="owner").collect()}
    assert {(h.repos, h.owners, h.verdict) for i in (*range(6), 20) for h in found[i]} == {(7, 1, "live")}
    assert {(h.repos, h.owners, h.verdict) for i in (*range(10, 16), 21) for h in found[i]} == {(1, 7, "copied")}
    masked = {r.doc_id: r.text for r in mask_live(docs, repo="repo", owner="owner").collect()}
    assert masked[3] == "token=" + "*" * len(own) and masked[12] == rows[8][1]
