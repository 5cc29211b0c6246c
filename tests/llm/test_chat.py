import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from riskpanel.llm import chat
from tests.llm.tables import CLASHES, rows_of

TURNS = "conv_id long, turn long, role string, text string"
PIECES = ["<", "<s>", "</s>", "\\", "[", "[INST]", "[\\INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
          chat.OPEN, chat.CLOSE + "\n", "<\\|im_end|>", "|im_end|>", "\n", " ", "é", "🙂", " a",
          "user", "INST]", "s>", "/"]


@pytest.fixture(scope="module")
def encoder():
    with open(public_tokenizers.path(chat.VOCABULARY), encoding="utf-8") as f:
        return chat.tokenizer(f.read())


def said(r, n):
    return "".join(r.choice(PIECES) for _ in range(r.randrange(n)))


def test_escapes_are_reversible_and_leave_no_control_string():
    r = random.Random(5)
    for _ in range(20_000):
        text = said(r, 9)
        escaped = chat.escaped(text)
        assert chat.unescaped(escaped) == text
        assert not any(c in escaped for c in chat.CONTROLS)


def test_turns_and_mask_are_read_back(encoder):
    r = random.Random(6)
    for _ in range(3000):
        turns = [(r.choice(["user", "assistant", "system", said(r, 4)]), said(r, 9))
                 for _ in range(r.randrange(1, 6))]
        text, spans = chat.rendered(turns)
        assert chat.read_back(text) == turns
        code = encoder.encode(text, add_special_tokens=False)
        tokens = np.array(code.offsets).reshape(-1, 2)
        mask, pieces = chat.masked(tokens, spans)
        loss = chat._under(text, pieces[:, 0].tolist(), pieces[:, 1].tolist())
        assert loss == "".join(t for role, t in turns if role == "assistant")
        want = [any(a < e and s < b for a, b in spans if b > a) for s, e in tokens]
        assert mask.tolist() == want


ROWS = [(1, 1, "assistant", "hi"), (1, 0, "user", "yo"), (2, 0, "system", None), (2, None, None, "x"),
        (3, 0, "user", ""), (3, 1, "assistant", ""), (None, 0, "assistant", "n"),
        (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (4, 0, "user", "b"),
        (5, 0, "assistant", "long é🙂 " * 20_000)]


def plain(rows):
    groups = {}
    for c, t, role, text in rows:
        groups.setdefault(c, []).append((t is not None, t, role is not None, role or "",
                                         text is not None, text or ""))
    out = []
    for c, turns in groups.items():
        turns = [(t[3], t[5]) for t in sorted(turns, key=lambda t: (t[0], t[1] or 0, *t[2:]))]
        loss = "".join(t for role, t in turns if role == "assistant")
        digest = hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        out.append((c, len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                    len(chat.rendered(turns)[0])))
    return sorted(out, key=repr)


def test_report(spark):
    df = spark.createDataFrame(ROWS, TURNS)
    for i, name in enumerate([*CLASHES, "formatted", "mask", "tokens"]):
        df = df.selectExpr("*", f"{i} as `{name}`")
    got = chat.report(df.repartition(3)).collect()
    assert sorted(((r["conv_id"], r["n_turns"], r["turns_sha256"], r["loss_chars"],
                    r["loss_sha256"], r["formatted_chars"]) for r in got), key=repr) == plain(ROWS)


def test_mask_has_a_value_for_every_token(spark):
    for r in chat.formatted(spark.createDataFrame(ROWS, TURNS)).collect():
        assert len(r["mask"]) == len(r["tokens"])


def test_many_conversations(spark):
    r = random.Random(7)
    rows = [(c, t, r.choice(["user", "assistant"]), said(r, 12)) for c in range(300)
            for t in range(r.randrange(1, 5))]
    got = chat.report(spark.createDataFrame(rows, TURNS)).collect()
    assert sorted(((r["conv_id"], r["n_turns"], r["turns_sha256"], r["loss_chars"],
                    r["loss_sha256"], r["formatted_chars"]) for r in got), key=repr) == plain(rows)


@pytest.mark.parametrize("kind", ["int", "string", "short"])
def test_other_types_of_ids(spark, kind):
    df = spark.createDataFrame(ROWS, TURNS)
    wanted = chat.report(df).selectExpr(f"cast(conv_id as {kind}) as conv_id", "* except (conv_id)")
    got = chat.report(df.withColumn("conv_id", df["conv_id"].cast(kind)))
    assert got.schema["conv_id"].dataType.simpleString() == ("smallint" if kind == "short" else kind)
    assert rows_of(got) == rows_of(wanted)


def test_empty_table(spark):
    assert rows_of(chat.report(spark.createDataFrame([], TURNS))) == []
