import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import ODD, no_docs, odd_docs

from sluice.llm.token_counts import Counter, Tree, apply_edits, build_trees, joined_edits, redactions

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PIECES = st.text(alphabet=st.sampled_from("aB'strevlmd 0 1\n\t.,!é漢 "), max_size=40)


@pytest.fixture(scope="module")
def counter():
    return Counter(RANKS, PATTERN)


@settings(max_examples=400, deadline=None)
@given(PIECES, st.lists(st.tuples(st.integers(0, 400), st.integers(0, 30), PIECES), max_size=6), st.integers(1, 8))
def test_edited_trees_count_like_fresh_ones(counter, text, edits, times):
    text *= times
    tree = Tree.build(text, counter)
    for a, n, new in edits:
        a = min(a, len(text))
        want = text[:a] + new + text[a + n:]
        text, _ = tree.edit(text, a, min(len(text), a + n), new, counter)
        assert text == want
        chars, tokens = tree.leaves
        assert sum(chars) == len(text) and sum(tokens) == len(counter.encode(text))
        assert tree.chars[1] == len(text) and tree.tokens[1] == sum(tokens)


def test_a_small_edit_touches_little(counter):
    text = " ".join(f"word{i}" for i in range(50_000))
    tree = Tree.build(text, counter)
    _, encoded = tree.edit(text, 200_000, 200_004, "x", counter)
    assert encoded < 200


def test_odd_documents(spark, counter):
    trees = build_trees(odd_docs(spark, ["chars", "tokens", "n_tokens"]), RANKS, PATTERN)
    got = apply_edits(trees, RANKS, PATTERN).collect()

    def edited(text):
        for a, b, new in reversed(redactions(text)):
            text = text[:a] + new + text[b:]
        return text

    want = [(d, len(counter.encode(t or "")), len(counter.encode(edited(t or "")))) for d, t, *_ in ODD]
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_tokens_before"], r["n_tokens"])) for r in got)


def test_redactions_apply(spark):
    df = spark.createDataFrame([(1, "call 0123456789 or 10.0.0.255, pin 1234")], "doc_id long, text string")
    r = apply_edits(build_trees(df, RANKS, PATTERN), RANKS, PATTERN).first()
    assert r["text"] == "call [number] or [ip], pin 1234" and r["n_edits"] == 2


def test_empty_table(spark):
    assert apply_edits(build_trees(no_docs(spark), RANKS, PATTERN), RANKS, PATTERN).collect() == []


def test_joined_edits_make_the_same_text():
    text = "ab 1234567 cd 7654321 " + "x" * 2000 + " 10.0.0.1 y"
    edits = redactions(text)
    joined = joined_edits(text, edits)
    assert len(edits) == 3 and len(joined) == 2

    def made(edits):
        out = text
        for a, b, new in reversed(edits):
            out = out[:a] + new + out[b:]
        return out

    assert made(joined) == made(edits) and joined_edits(text, []) == []


def test_many_edits_cost_about_a_rebuild(spark, counter):
    text = " ".join(f"n {i + 1000000}" for i in range(20_000))
    r = apply_edits(build_trees(spark.createDataFrame([(1, text)], "doc_id long, text string"), RANKS, PATTERN), RANKS, PATTERN).first()
    pieces = len(counter.pattern.findall(r["text"]))
    assert r["n_edits"] == 20_000 and r["n_tokens"] == len(counter.encode(r["text"])) and r["n_encoded"] <= pieces
