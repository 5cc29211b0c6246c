import re
from collections import Counter

import pytest

from riskpanel.llm import quality
from tests.llm.tables import empty_documents, odd_documents, odd_rows, prose, rows_of


def plain_figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    hit = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(hit),
            len(words) < 20 or 100 * len(hit) > 30 * len(words))


def test_figures_equal_definitions(spark):
    got = quality.quality_report(odd_documents(spark)).collect()
    have = sorted(((r["doc_id"], *(r[f] for f in quality.FIGURES), r["base_failed"]) for r in got),
                  key=repr)
    assert have == sorted(((r[0], *plain_figures(r[1])) for r in odd_rows()), key=repr)
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_a_kept_text_goes_to_python_once(spark, monkeypatch):
    df = odd_documents(spark)
    sent = []
    plain = type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow",
                        lambda d, *a, **k: (sent.append(d.schema.simpleString()), plain(d, *a, **k))[1])
    rows = quality.measured(df)
    assert [x.count("text:string") for x in sent] == [1]
    assert rows_of(rows.select("__kept_row.*", "__n_words", "__lines")) == rows_of(
        quality.measured(df.withColumn("again", df["text"]), df.columns, "again")
        .select("__kept_row.*", "__n_words", "__lines"))


def test_bad_host_loses_what_fails_and_keeps_clean_documents(spark):
    good = [(i, prose(i, 40), "en", f"h{i % 5}", 0) for i in range(50)]
    junk = " ".join(f"{w}#%*" for w in prose(99, 40).split())
    bad = [(100 + i, junk + f" w{i}", "en", "bad", 0) for i in range(40)]
    clean = [(200, prose(200, 40), "en", "bad", 0)]
    stray = [(300, junk, "en", "h1", 0)]
    df = odd_documents(spark, good + bad + clean + stray)
    kept = {r["doc_id"] for r in quality.quality_report(df).where("kept").collect()}
    assert kept == {r[0] for r in good + clean + stray}
    out = quality.keep_good(df)
    assert out.columns == df.columns
    assert {r["doc_id"] for r in out.collect()} == kept


def test_prior_follows_the_hosts_spread():
    # 10 hosts of 100 documents with rates 0 or 1: hosts differ, so the prior is weak
    weak = quality.beta_prior(1000, 10, 500, 5 * 100.0)
    assert sum(weak) < 1
    # all hosts at one half: no more spread than sampling gives, so the prior is strong
    strong = quality.beta_prior(1000, 10, 500, 10 * 25.0)
    assert sum(strong) > 100 and strong[0] == pytest.approx(strong[1])
    assert quality.beta_prior(0, 0, 0, 0.0) == (0.5, 0.5)
    assert quality.beta_prior(10, 2, 0, 0.0)[0] < quality.beta_prior(10, 2, 10, 10.0)[0]


def test_empty_table(spark):
    assert rows_of(quality.quality_report(empty_documents(spark))) == []
    assert rows_of(quality.keep_good(empty_documents(spark))) == []


def test_base_failures_of_a_host_count_against_its_doubtful_documents(spark):
    junk = " ".join(f"{w}#%*" for w in prose(99, 40).split())
    good = [(i, prose(i, 40), "en", f"h{i % 6}", 0) for i in range(240)]
    short = [(1000 + i, "too short", "en", "bad", 0) for i in range(60)]
    doubtful = [(2000, junk, "en", "bad", 0), (2001, junk, "en", "h1", 0)]
    clean = [(3000, prose(500, 40), "en", "bad", 0)]
    df = odd_documents(spark, good + short + doubtful + clean)
    kept = {r["doc_id"] for r in quality.quality_report(df).where("kept").collect()}
    assert kept == {r[0] for r in good + clean} | {2001}


def test_hosts_alike_lose_nothing(spark):
    junk = " ".join(f"{w}#%*" for w in prose(99, 40).split())
    rows = [(100 * h + i, junk if i == 0 else prose(100 * h + i, 40), "en", f"h{h}", 0)
            for h in range(6) for i in range(20)]
    report = quality.quality_report(odd_documents(spark, rows))
    assert report.where("kept").count() == len(rows)
