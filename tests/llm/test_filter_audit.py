import re
from collections import Counter
from itertools import permutations

from riskpanel.llm import filter_audit
from tests.compare import sql_rows
from tests.llm.tables import DOCUMENTS, empty_documents, odd_documents, odd_rows, prose, rows_of

LABELS = "doc_id long, quality int, toxic int, text string"


def labels_of(spark, rows):
    return spark.createDataFrame([(*r, "other") for r in rows], LABELS)


def plain_masks(rows):
    """(part, set of failed filters) of every row, straight from the definitions."""
    whole = [(i, t or "", s or "") for i, t, _, s, _ in rows]
    for i, text, part in whole:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = any(t == text and j is not None and i is not None and j < i
                      for j, t, _ in whole)
        tests = (len(words) < 200, 100 * len(set(words)) < 50 * len(words),
                 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                 re.search(r"[#$%&*|]", text), smaller)
        yield part, "".join(c for c, failed in zip("ABCDE", tests) if failed)


def plain_audit(rows, labels):
    quality, toxic = ({i for i, *r in labels if i is not None and r[k] == 1} for k in (0, 1))
    out = Counter()
    masks = [(p, m, r[0] in quality, r[0] in toxic) for (p, m), r in zip(plain_masks(rows), rows)]
    shapley = Counter()
    for order in map("".join, permutations("ABCDE")):
        for part, mask, good, bad in masks:
            gone = False
            for step, letter in enumerate(order, 1):
                key = part, order, step
                out[key, "rows"] += 1
                if letter in mask:
                    out[key, "redundant" if gone else "removed"] += 1
                    out[key, "unique_fails"] += mask == letter
                    if not gone:
                        out[key, "good_lost"] += good
                        out[key, "toxic_lost"] += bad
                        shapley[part, letter] += 1
                    gone = True
                out[key, "kept"] += not gone
    names = ["filter_order", "good_lost", "kept", "part", "redundant", "removed", "shapley", "step",
             "toxic_lost", "unique_fails"]
    return sorted((tuple({"part": k[0], "filter_order": k[1], "step": k[2],
                          "shapley": shapley[k[0], k[1][k[2] - 1]]}.get(n, out[k, n])
                         for n in names)
                   for k in {k for k, _ in out}), key=repr)


LABELED = [(5, 1, 0), (9, 1, 1), (9, 0, 0), (16, 1, 1), (20, 0, 1), (None, 1, 1), (3, None, 1)]


def test_odd_rows_equal_definitions(spark):
    got = filter_audit.audit(odd_documents(spark), labels_of(spark, LABELED))
    assert rows_of(got) == plain_audit(odd_rows(), LABELED)


def test_salted_texts_and_joined_digests_change_nothing(spark, monkeypatch):
    copy = prose(4, 220)
    rows = [(i, copy if i % 3 else prose(i, 30) + " A#" * (i % 2), "en", f"s{i % 2}", 0)
            for i in range(200)]
    wanted = plain_audit(rows, LABELED)
    monkeypatch.setattr(filter_audit, "HOT_BYTES", 100)
    monkeypatch.setattr(filter_audit, "SMALL", 0)
    got = filter_audit.audit(odd_documents(spark, rows), labels_of(spark, LABELED))
    assert rows_of(got) == wanted


def test_same_digest_of_other_texts_is_no_copy(spark, monkeypatch):
    rows = [(1, "a b", "en", "x", 0), (2, "c d", "en", "x", 0), (3, "a b", "en", "x", 0)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    plain = filter_audit._rows

    def clashing(documents, part):
        return plain(documents, part).selectExpr("doc_id", "part", "text", "X'00' as digest")

    monkeypatch.setattr(filter_audit, "_rows", clashing)
    flags = filter_audit.flagged(df)
    assert [r["doc_id"] for r in filter_audit.copies(df, flags).collect()] == [3]


def test_equals_sql(spark, folder):
    import duckdb

    df = odd_documents(spark).select("doc_id", "text", "source")
    df.toPandas().to_parquet(f"{folder}/d.parquet")
    labels_of(spark, LABELED).toPandas().to_parquet(f"{folder}/l.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text, source "
                f"FROM '{folder}/d.parquet'")
    con.execute(f"CREATE VIEW labels AS SELECT doc_id::BIGINT AS doc_id, quality, toxic "
                f"FROM '{folder}/l.parquet'")
    _, wanted = sql_rows(con, filter_audit.report_sql())
    got = filter_audit.audit(df, labels_of(spark, LABELED))
    assert rows_of(got) == wanted


def test_empty_tables(spark):
    none = labels_of(spark, [])
    assert filter_audit.audit(empty_documents(spark), none).collect() == []
    rows = filter_audit.audit(odd_documents(spark), none)
    assert rows.where("good_lost + toxic_lost > 0").isEmpty()
    assert rows.count() == 600 * len({r[3] for r in odd_rows()})


def test_text_is_compared_in_one_row_per_text(spark):
    df = odd_documents(spark)
    plan = filter_audit.copies(df, filter_audit.flagged(df))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
