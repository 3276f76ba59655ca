"""Phrases against a word scan, templates with words put in, left out and cut, and the query against SQL."""

from tests.compare import connect, differences
from tests.llm.brute import EDGE, LETTERS, docs_of, low, prose
from txnflow.llm import license_scan as L
from txnflow.llm.queries import QUERIES
from txnflow.llm.sql import SQL

MIT = L.TEMPLATES["mit-text"]
TEXTS = EDGE + [
    (40, "Apache-License, apache license; CC BY-NC 4.0 cc by cc by MIT LICENSE mit license mit"),
    (41, prose(300, 1) + " " + MIT + " " + prose(300, 2)),
    (42, MIT.replace("free of charge", "wholly free of any charge") + " " + MIT),
    (43, " ".join(MIT.split()[:6])),  # too little of it
    (44, "GNU general\npublic LICENSE"),
    (45, "hereby granted free " * 40),
    (46, "Released under the MIT License. " * 3),
]


def brute(text):
    w = LETTERS.findall(low(text))
    starts, labels = [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        for i in range(len(w)):
            if w[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(w), sorted(starts), sorted(labels)


def test_phrases(spark):
    got = L.phrase_places(docs_of(spark, TEXTS)).collect()
    rows = sorted(((r["doc_id"], r["n_words"], sorted(r["starts"]), sorted(r["base"])) for r in got), key=repr)
    assert rows == sorted(((i, *brute(t)) for i, t in TEXTS), key=repr)


def test_template_spans(spark):
    spans = {}
    for r in L.template_spans(docs_of(spark, TEXTS)).collect():
        spans.setdefault((r["doc_id"], r["label"]), []).append((r["first_word"], r["last_word"], round(r["score"], 2)))
    n = len(LETTERS.findall(low(MIT)))
    assert spans[(41, "mit-text")] == [(300, 299 + n, 1.0)]
    first, second = sorted(spans[(42, "mit-text")])
    assert first[0] == 0 and 0.6 <= first[2] < 1 and second == (n + 2, 2 * n + 1, 1.0)
    assert len(spans[(46, "mit-notice")]) == 3
    assert not [k for k in spans if k[0] in (43, 45)]


def test_every_row_is_judged(spark):
    got = L.scan_licenses(docs_of(spark, TEXTS))
    assert got.count() == len(TEXTS) and got.where("not score between 0 and 1").count() == 0
    assert L.scan_licenses(docs_of(spark, [])).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(QUERIES["op6_license_scan"](spark, sf), connect(sf), SQL["op6_license_scan"]) == []
