import random

from pyspark.sql import functions as F

from hiregrain.llm.byte_bpe import source
from hiregrain.llm.token_counts import Trie, counted


def greedy(word, vocabulary, longest):
    pieces = at = 0
    while at < len(word):
        sizes = [k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in vocabulary]
        if not sizes:
            return 1
        pieces, at = pieces + 1, at + sizes[0]
    return pieces


def test_automaton_equals_greedy_matching():
    draw = random.Random(2)
    for _ in range(150):
        size = range(draw.randint(1, 25))
        vocabulary = {bytes(draw.choices(b"abc", k=draw.randint(1, 6))) for _ in size}
        words = [bytes(draw.choices(b"abcd"[: draw.choice([3, 4])], k=draw.randint(1, 30))) for _ in range(40)]
        found = Trie.of(list(vocabulary)).automaton().counts(words).tolist()
        assert found == [greedy(word, vocabulary, 6) for word in words]


def test_odd_rows(odd_docs):
    vocabulary = source().ranks
    longest = max(map(len, vocabulary))
    rows = counted(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        words = (row["row"]["text"] or "").encode().split()
        if len(words) < 1000:
            want = sum(greedy(b" " + word, vocabulary, longest) for word in words)
            assert (row["n_words"], row["n_tokens"]) == (len(words), want)
    assert counted(odd_docs.where(F.lit(False))).count() == 0
