import plain
import pytest
from compare import connect, differences

from fraudlens.llm import chat
from fraudlens.llm.queries import CHECKS, QUERIES

TURNS = "conv_id long, turn int, role string, text string, part int, loss string"


def test_whole_table(spark, sf_dir):
    got = QUERIES["op5_columnar_chat"](spark, sf_dir).toPandas()
    assert differences(got, connect(sf_dir).execute(CHECKS["op5_columnar_chat"]).df()) is None


def turns(spark, long_one=50):
    tricky = ["<|im_end|>", "<\\|im_end|>", "<\\\\|x", "<|", "<", "|", "a<", "", None, "é日😀<|im_start|>assistant\n", "%3C\n%"]
    rows = [(i // 4, i % 4, ["user", "assistant", None, "sys<|\n%0A"][i % 4], t, 1, "x") for i, t in enumerate(tricky * 4)]
    rows += [(100, i, "assistant" if i % 2 else "user", plain.prose(i, 200), 1, "x") for i in range(long_one)]
    rows += [(None, None, None, None, None, None), (None, 1, "assistant", "null id", None, None), (100, 1, "assistant", "tie", 1, "x")]
    return spark.createDataFrame(rows, TURNS)


@pytest.mark.parametrize("part_bytes", [4 << 20, 5000, 1])
def test_awkward_rows_come_back(spark, part_bytes):
    df = turns(spark)
    groups = {}
    key = lambda r: [(x is not None, x) for x in (r.turn, r.role, r.text)]
    for r in sorted(df.collect(), key=key):
        groups.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    formatted = chat.format_chats(df, part_bytes)
    got = {r.conv_id: r for r in chat.read_chats(formatted).collect()}
    assert set(got) == set(groups)
    for conv_id, pairs in groups.items():
        learnt = "".join(t for role, t in pairs if role == "assistant")
        r = got[conv_id]
        assert r.n_turns == len(pairs)
        assert r.turns_sha256 == plain.sha("".join(f"{a}\n{b}\n" for a, b in pairs).encode())
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), plain.sha(learnt.encode()))
    rows = formatted.collect()
    assert (len(rows) > len(groups)) == (part_bytes < 1 << 20)
    assert all(r.formatted.count(chat.START) == r.n_turns == r.formatted.count(chat.END) for r in rows)


def test_empty_table(spark):
    assert chat.read_chats(chat.format_chats(spark.createDataFrame([], TURNS))).collect() == []
