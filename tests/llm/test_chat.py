import hashlib
import pickle
import random

import pytest
from pyspark.sql import functions as F

from bulkflow.llm import chat_template as ct
from bulkflow.llm.contract import ADDED, CHAT, CONTROLS, QUERIES, TURN

ROWS = "conv_id long, turn long, role string, text string, piece string, part string, spans int, conversation string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests_by_hand(rows):
    """What op13 returns, but for the length of the formatted text, from (conv_id, turn, role, text)."""
    out = {}
    for i in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0), r[2] or "", r[3] or "") for r in rows if r[0] == i)
        loss = "".join(t for _, role, t in turns if role == "assistant")
        out[i] = (len(turns), sha("".join(f"{role}\n{t}\n" for _, role, t in turns)), len(loss), sha(loss))
    return out


HOSTILE = ["</s>", "[INST]", "[/INST]", "<s>", "[ROLE]", "[/ROLE]", "<\\/s>", "<\\\\/s>", "[\\INST]", "\\", "<", "[", "/s>", "é😀", "a", " ", "\n", "{{ x }}", "{% endfor %}"]


def test_protection_is_reversible_and_hides_controls():
    p, r = ct.Protection(CONTROLS), random.Random(2)
    for _ in range(3000):
        text = "".join(r.choice(HOSTILE) for _ in range(r.randint(0, 12)))
        hidden = p.protect(text)
        assert not any(c in hidden for c in CONTROLS) and p.restore(hidden) == text
    for bad in (["<"], ["<\\x"], ["<a", "b<"]):
        with pytest.raises(ct.TemplateError):
            ct.Protection(bad)


def test_constants_fold_and_closures_agree():
    tree = ct.fold(ct.parse("{% if not false %}a{{ 1 + 2 * 3 }}{{ 'x' | upper }}{% else %}{{ y }}{% endif %}b"), ct.FILTERS)
    assert tree == ("block", ("text", "a7Xb"))
    source = "{% for m in messages %}{% if m.n > 2 and m.s %}A{% elif m.n == 1 %}B{% else %}C{% endif %}{% set t = m.s ~ '!' %}{{ t | default('-') }}{% for x in m.xs %}<{{ x.v if x.v else 'none' }}>{% endfor %}{{ -1 + m.n }}{% endfor %}"
    t = pickle.loads(pickle.dumps(ct.Template(source, [])))
    assert t.message({"n": 3, "s": "q", "xs": [{"v": 1}, {}]}) == ("Aq!<1><none>2", [])
    assert t.message({"n": 1, "s": "", "xs": []})[0] == "B!0" and t.opening() == ("", [])
    trimmed = ct.Template(" x {%- for m in messages -%}  {{- ' y ' -}}  {% endfor %}{# note #}", [])
    assert trimmed.opening()[0] == " x" and trimmed.message({})[0] == " y "


@pytest.mark.parametrize(
    "source",
    ["{{ m.f() }}", "{{ m | nothing }}", "{% import os %}", "{{ 'a' * 9 }}", "{{ messages }}", "{% if x %}", "{% endif %}", "{{ 1 + }}", "{{ ; }}", "{% for in x %}{% endfor %}"],
)
def test_refused_templates(source):
    with pytest.raises(ct.TemplateError):
        ct.Template("{% for m in messages %}" + source + "{% endfor %}", [])


def test_python_is_out_of_reach():
    t = ct.Template("{% for m in messages %}[{{ m.__class__ }}{{ m.text.__len__ }}{{ m['text']['x'] }}]{% endfor %}", [])
    assert t.message({"text": "x"})[0] == "[]"
    with pytest.raises(ct.TemplateError):
        ct.Template("{% for m in messages %}{{ m.a + m.b }}{% endfor %}", []).message({"a": 1, "b": "x"})
    with pytest.raises(ct.TemplateError):
        ct.Template("no loop", [])


def odd_conversations():
    r = random.Random(5)
    rows = [(None, 1, "user", "no id"), (None, None, None, None), (1, None, "assistant", "null turn"), (1, 0, "user", None), (1, 0, "user", None)]
    rows += [(1, 0, "assistant", "tie"), (2, 5, "", ""), (3, 1, "assistant", "x" * 300_000), (4, -2, "[ROLE]", "[/ROLE]"), (5, 1, "Assistant", "not it"), (6, 0, "assistant", "")]
    rows += [(7, n, r.choice(["user", "assistant", "tool"]), "".join(r.choice(HOSTILE) for _ in range(r.randint(0, 9)))) for n in range(3000)]  # a hot one
    return rows + [(100 + n // 4, n % 4, r.choice(["user", "assistant"]), f"turn {n}") for n in range(200)]


def test_the_query_reads_back_what_was_said(spark, tmp_path):
    rows = odd_conversations()
    clash = [(*x, "p", "q", 1, "c") for x in rows]
    spark.createDataFrame(clash, ROWS).repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {x["conv_id"]: x for x in QUERIES["op13_chat_template"](spark, str(tmp_path)).collect()}
    expected = digests_by_hand(rows + ADDED)
    assert {i: tuple(x)[1:5] for i, x in found.items()} == expected
    t = ct.Template(CHAT, CONTROLS)
    for i, x in found.items():
        mine = [r for r in rows + ADDED if r[0] == i]
        length = len(t.opening()[0]) + len(t.closing()[0]) + sum(len(t.message({"role": r[2], "text": r[3]})[0]) for r in mine)
        assert x["formatted_chars"] == length
    assert found[-7]["loss_chars"] == len(ADDED[1][3])


def test_pieces_make_whole_texts(spark):
    rows = spark.createDataFrame([(1, 2, "assistant", "</s>"), (1, 1, "user", "hi"), (2, 1, "user", None)], "conv_id long, turn long, role string, text string")
    pieces = ct.format_conversations(rows, ct.Template(CHAT, CONTROLS), "conv_id", "turn", ("role", "text"))
    texts = pieces.groupBy("conversation").agg(ct.formatted_text(F.col("piece"), F.col("part"), F.col("turn")).alias("t")).collect()
    assert {x[0]: x[1] for x in texts} == {1: "<s>[ROLE]user[/ROLE][INST]hi[/INST][ROLE]assistant[/ROLE]<\\/s></s></s>", 2: "<s>[ROLE]user[/ROLE][INST][/INST]</s>"}
    one = pieces.where("conversation = 1 and size(spans) > 0").first()
    assert one["piece"][one["spans"][0]["start"] : one["spans"][0]["end"]] == "<\\/s>"


def test_damaged_output_is_refused():
    t = ct.Template(CHAT, CONTROLS)
    for pieces in (["<s>", "[ROLE]user[/ROLE]"], ["oops", "</s>"], ["<s>"]):
        reader = ct.Reader(TURN, *(x()[0] for x in (t.opening, t.closing)), t.protection)
        with pytest.raises(ct.TemplateError):
            for p in pieces:
                reader.feed(p, [])
            reader.result()
    whole = "<s>[ROLE]user[/ROLE][INST]hi[/INST][ROLE]assistant[/ROLE]yes</s></s>"
    for cut in range(len(whole)):  # the borders of the pieces do not matter
        reader = ct.Reader(TURN, "<s>", "</s>", t.protection)
        reader.feed(whole[:cut], [])
        reader.feed(whole[cut:], [])
        assert reader.result()[:2] == (2, sha("user\nhi\nassistant\nyes\n"))


def test_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    t = ct.Template(CHAT, CONTROLS)
    pieces = ct.format_conversations(none, t, "conv_id", "turn", ("role", "text"))
    assert pieces.count() == 0 and ct.read_back(pieces, TURN, t).count() == 0
