import random

from pyspark.sql import functions as F

from riskpanel.llm import decontaminate
from tests.llm.tables import empty_documents, odd_documents, prose, rows_of

ITEMS = "item_id long, text string"


def pairs(documents, items, spark):
    out = decontaminate.contaminated(documents, spark.createDataFrame(items, ITEMS))
    return sorted(((r["doc_id"], r["item_id"]) for r in out.collect()), key=repr)


def docs(spark, *texts_):
    return spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")


def test_template(spark):
    row = docs(spark, "He paid $12.50 for 3kg near Paris, and 7 km on. Then Rome fell in 1999.")
    got = row.select(decontaminate.template(F.col("text"))).first()[0]
    assert got == ("he paid <unit><num> for <num><unit> near <name>, and <num> <unit> on. then "
                   "<name> fell in <num>.")


def test_other_numbers_names_and_units_are_caught(spark):
    item = "He ran 12 km in Paris and then 12 more km with 7 dogs to Rome and slept"
    found = pairs(docs(
        spark,
        "Foo bar. He ran 99 miles in London and then 99 more miles with 3 dogs to Bonn and slept.",
        "He ran 9 km in Paris and then 8 more km with 7 dogs to Rome and slept",  # 12 is 9 and 8
        "He walked 12 km in Paris or then 12 more km for 7 dogs off Rome but slept",
        item, "nothing of this"), [(1, item)], spark)
    assert found == [(0, 1), (3, 1)]


def test_planted_passages(spark):
    r = random.Random(6)
    items = [(i, prose(1000 + i, r.randrange(9, 50))) for i in range(30)]
    rows, want = [], set()
    for d in range(300):
        words = prose(d, r.randrange(1, 150)).split()
        for _ in range(r.randrange(3) if d % 3 == 0 else 0):
            i, text = r.choice(items)
            at = r.randrange(len(words) + 1)
            words[at:at] = ["end."] + text.split()
            want.add((d, i))
        rows.append((d, " ".join(words), "en", "s", 0))
    # a passage that another one was put into need not be whole any more
    got = set(pairs(odd_documents(spark, rows), items, spark))
    whole = {(d, i) for d, i in want if items[i][1] in rows[d][1]}
    assert whole <= got <= want


def test_defined_results(spark):
    long = prose(5, 40)
    rows = [(1, None, "", "", 0), (2, "", "", "", 0), (3, " \n", "", "", 0), (4, long, "", "", 0),
            (4, long, "", "", 0), (None, long, "", "", 0), (5, "three words only", "", "", 0),
            (6, "not three words only", "", "", 0), (7, "x " * 50_000 + long, "", "", 0)]
    df = odd_documents(spark, rows)
    items = [(1, long), (1, long), (2, None), (3, ""), (4, "three words only"), (None, long)]
    assert pairs(df, items, spark) == sorted(
        [(d, i) for d in (4, None, 7) for i in (1, None)] + [(5, 4)], key=repr)
    benchmark = spark.createDataFrame(items, ITEMS)
    out = decontaminate.drop_contaminated(df, benchmark)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 2, 3, 6]
    nothing = spark.createDataFrame([], ITEMS)
    assert rows_of(decontaminate.contaminated(df, nothing)) == []
    assert decontaminate.drop_contaminated(df, nothing).count() == len(rows)
    assert rows_of(decontaminate.contaminated(empty_documents(spark), benchmark)) == []


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    items = [(i, prose(i, 30)) for i in range(5)]
    df = docs(spark, *(f"{prose(50 + i, 20)}. {items[i % 5][1]}" for i in range(20)))
    before = pairs(df, items, spark)
    monkeypatch.setattr(decontaminate, "SMALL", 0)
    assert pairs(df, items, spark) == before and len(before) == 20


def test_no_python_in_the_plan(spark):
    df = decontaminate.contaminated(docs(spark, prose(1)), spark.createDataFrame(
        [(1, prose(1))], ITEMS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_short_runs_are_found_at_every_offset(spark):
    item = prose(7, 15)
    words = item.split()
    words[7] = "changed"
    df = docs(spark, *(f"{prose(60, 20 + i)} {' '.join(words)} {prose(61, 20)}" for i in range(8)))
    found = [(d, 1) for d in range(8)]
    assert pairs(df, [(1, item)], spark) == found
    assert pairs(df, [(1, item), (2, prose(8, 8))], spark) == found


def test_a_value_that_breaks_takes_only_its_own_windows(spark):
    item = f"{prose(71, 20)} 5 {prose(72, 18)} 5 {prose(73, 20)}"
    first = item.replace(" 5 ", " 7 ", 1)  # 5 is 7 and 5
    both = first.replace(" 5 ", " 8 ")  # 5 is 7 and 8
    name = f"{prose(74, 12)}, Anna {prose(75, 12)}, Anna {prose(76, 12)}"
    cut = f"{prose(72, 4)} 7 {prose(77, 30)}"
    df = docs(spark, item, first, both, name.replace("Anna", "Berta", 1), cut)
    assert pairs(df, [(1, item), (2, name)], spark) == [(0, 1), (1, 1), (2, 1), (3, 2)]


def test_rows_that_share_an_id_are_judged_by_their_text(spark):
    item = prose(70, 40)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, item, "en", "x", 0), (None, prose(71, 60), "en", "x", 0),
            (4, "before " + item, "en", "x", 0), (4, prose(72, 60), "en", "x", 0)]
    left = decontaminate.drop_contaminated(odd_documents(spark, rows), bench).collect()
    assert sorted(r["text"] for r in left) == sorted([prose(71, 60), prose(72, 60)])
