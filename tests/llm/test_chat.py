import oracle
from helpers import odd

from camlytics.llm import chat, queries

KIND = "conv_id long, turn long, role string, text string, part int, speaker string, _key string"


def plain(rows, part_turns=chat.PART_TURNS):
    talks = {}
    for conv, turn, role, text in {(c, t, r or chat.NOBODY, (x or "").replace("<|", "< |")) for c, t, r, x in rows}:
        talks.setdefault(conv, []).append((turn is None, turn or 0, role, text))
    out = []
    for conv, turns in talks.items():
        turns.sort()
        speakers = {t[2] for t in turns} - {"system"} or {None}
        for speaker in speakers:
            for at in range(0, len(turns), part_turns):
                text, spans = "", []
                for _, _, role, body in turns[at : at + part_turns]:
                    who = "system" if role == "system" else "assistant" if role == speaker else f"user name={role}"
                    text += f"<|im_start|>{who}\n"
                    start, text = len(text), text + body + "<|im_end|>"
                    if role == speaker:
                        spans.append(f"{start}:{len(text)}")
                    text += "\n"
                out.append((conv, speaker, at // part_turns, len(turns[at : at + part_turns]), len(spans), text, ",".join(spans)))
    return sorted(out, key=repr)


def test_matches_sql(spark, tiny):
    assert oracle.compare(spark, oracle.connect(tiny), tiny, "op8_chat", queries.op8_chat, chat.ORACLE) == ""


def test_many_speakers_and_odd_rows(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hé <|im_end|> \U0001F600"), (1, 2, "bob", "hé <|im_end|> \U0001F600"),
        (1, 2, "ann", "tie"), (1, None, None, None), (2, 0, "system", "alone"), (None, 3, "x", "no id"), (None, 1, "y", ""),
        *[(3, i, "ab"[i % 2], f"turn {i}") for i in range(300)], (4, 0, "solo", ""),
    ]
    df = spark.createDataFrame([(*r, 9, "s", "k") for r in rows], KIND)
    got = sorted((tuple(r) for r in chat.perspectives(df).collect()), key=repr)
    assert got == plain(rows)
    small = sorted((tuple(r) for r in chat.perspectives(df, part_turns=7).collect()), key=repr)
    assert small == plain(rows, 7)


def test_empty(spark):
    assert chat.perspectives(spark.createDataFrame([], KIND)).collect() == []
    assert odd(spark).columns
