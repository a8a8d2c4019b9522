import hashlib
import random

from tessera.llm import chat


def test_round_trip_with_control_strings(spark):
    rng = random.Random(8)
    pieces = ["[INST]", "[/INST]", "<s>", "</s>", "[", "]", "\\", "\\\\", "/INST]", "s>", "<", "text", "\n", " ", "é", "", "[\\INST]",
              "<\\\\/s>", "$1"]
    roles = ["user", "assistant", "system", None, "", "odd\nrole", "a\\nb", "[INST]", "<s>x", "\\", "ASSISTANT"]
    rows = [(c, t, rng.choice(roles), None if rng.random() < 0.05 else "".join(rng.choices(pieces, k=rng.randint(0, 9))))
            for c in range(300) for t in range(rng.randint(1, 6))]
    df = spark.createDataFrame([r + (1, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, raw int, source string")
    found = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    for c in {r[0] for r in rows}:
        source = [(role or "", text or "") for i, _, role, text in rows if i == c]
        r = found[c]
        assert [tuple(t) for t in r.turns] == source and r.round_trip
        assert "".join(s.text for s in r.segments) == r.formatted
        assert sum(s.loss for s in r.segments) == sum(role == "assistant" for role, _ in source)
    assert any(r.n_escaped for r in found.values()) and any(not r.n_escaped for r in found.values())


def test_ties_repeats_nulls_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "first"), (None, 0, "user", "n"),
            (2, 0, "assistant", "z" * 300000)]
    df = spark.createDataFrame(rows, schema)
    found = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert [t.text for t in found[1].turns] == ["first", "a", "a", "b"]
    assert found[None].round_trip and len(found[2].formatted) == 300007
    assert chat.format_conversations(df.limit(0)).collect() == []


def test_probe_conversation(spark, small_dir):
    r = chat.query(spark, small_dir).filter("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (r.loss_chars, r.loss_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())
