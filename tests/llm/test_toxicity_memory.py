"""Memory of the fit on the driver."""

import random
import tracemalloc

from bazarlake.llm import toxicity


def sample(n_docs, n_words):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(2000)]
    texts, toxic = [], []
    for i in range(n_docs):
        words = rng.choices(vocabulary, k=n_words)
        if i % 3 == 0:
            words[5::50] = ["vilezor"] * len(words[5::50])
        texts.append(" ".join(words).encode())
        toxic.append(int(i % 3 == 0))
    return texts, toxic


def test_fit_holds_numbers_and_the_words_of_one_text():
    texts, toxic = sample(200, 600)
    tracemalloc.start()
    toxicity.fit_sample(texts, toxic, epochs=0)
    _, few = tracemalloc.get_traced_memory()
    tracemalloc.reset_peak()
    texts, toxic = sample(800, 600)
    held = tracemalloc.get_traced_memory()[0]
    toxicity.fit_sample(texts, toxic, epochs=0)
    _, many = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    more = 600 * 600  # words
    assert many - held - few < 30 * more, "a word of the sample takes a few numbers, no object of its own"


def test_fit_of_few_or_one_sided_labels_is_the_empty_model():
    for texts, toxic in (([], []), ([b"a b c"], [1]), ([b"", b" "], [0, 1]), ([b"a b c", b"a b c"], [0, 1])):
        assert toxicity.fit_sample(texts, toxic).document is None


def test_repeated_texts_are_learnt_once():
    texts, toxic = sample(60, 80)
    once = toxicity.fit_sample(texts, toxic, epochs=3)
    again = toxicity.fit_sample([t for t in texts for _ in range(3)], [y for y in toxic for _ in range(3)], epochs=3)
    assert (once.weights == again.weights).all() and (once.document == again.document).all()
