"""Decontamination against a scan of every window, with planted and edge-case texts."""

from tests.compare import connect, differences
from tests.llm.brute import EDGE, LETTERS, docs_of, low, prose
from txnflow.llm.decontaminate import contamination, drop_contaminated
from txnflow.llm.queries import QUERIES
from txnflow.llm.sql import SQL

ITEMS = [
    (1, prose(40, 5)),
    (2, prose(13, 6)),
    (3, "Just five words, here!"),
    (4, None),
    (5, "..."),
    (6, prose(12, 8)),
    (7, prose(40, 5)),
    (None, "solo"),
    (8, "a a a a a a a a a a a a a a a a a a a a"),
]
TEXTS = EDGE + [
    (20, prose(40, 5)),
    (21, "x " * 30 + " ".join(prose(40, 5).split()[10:23]).upper() + " y" * 200),
    (22, "x " * 30 + " ".join(prose(40, 5).split()[10:22]) + " y" * 200),  # 12 words: no window
    (23, "z " + prose(13, 6) + " z " + prose(12, 8)),
    (24, "just five WORDS here and solo, again just five words here"),
    (25, "a " * 60),
    (26, "a " * 12),
    (27, prose(2000, 9) + " " + prose(40, 5) + " " + prose(40, 5)),
]


def brute(rows, items):
    words = lambda t: LETTERS.findall(low(t))
    windows = {}
    for i, text in items:
        w = words(text)
        n = min(13, len(w))
        for s in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[s : s + n]), set()).add("" if i is None else str(i))
    lens, out = {len(w) for w in windows}, []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for n in lens:
            for s in range(len(w) - n + 1):
                if got := windows.get(tuple(w[s : s + n])):
                    hit |= set(range(s, s + n))
                    found |= got
        out.append((i, len(w), len(hit), len(found), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_planted_and_edge_cases(spark):
    got = contamination(docs_of(spark, TEXTS), items_of(spark, ITEMS)).drop("th")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(TEXTS, ITEMS)


def test_contaminated_documents_go_and_the_rest_stay_whole(spark):
    docs = docs_of(spark, TEXTS)
    left = drop_contaminated(docs, items_of(spark, ITEMS))
    assert left.columns == docs.columns
    clean = [r[0] for r in brute(TEXTS, ITEMS) if not r[5]]
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted(clean, key=repr)


def test_empty_tables(spark):
    assert contamination(docs_of(spark, []), items_of(spark, ITEMS)).count() == 0
    none = contamination(docs_of(spark, TEXTS), items_of(spark, []))
    assert none.where("contaminated or n_hit > 0").count() == 0 and none.count() == len(TEXTS)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op2_decontaminate"](spark, sf)
    assert differences(got, connect(sf), SQL["op2_decontaminate"]) == []
    assert got.where("contaminated").count() > 0
