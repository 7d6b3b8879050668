"""The models of the secret scan: names that were not in the samples, random strings of several alphabets, spans by hand."""

import random

import pytest

from reelhouse.llm import secret_markov
from reelhouse.llm.secret_markov import ALPHABET, LEAST_RATIO, TOKEN

#: Words that ``secret_markov.NAME_WORDS`` does not have.
WORDS = ("orange invoice customer weather temperature warehouse student browser mountain physics quality jacket velocity "
         "triangle bridge kitchen engine flower hammer journey keyboard machine ocean pencil rabbit silver umbrella yellow").split()
ALPHABETS = {"letters and digits": ALPHABET[:62], "hex": "0123456789abcdef", "base64": ALPHABET[:64],
             "small letters and digits": ALPHABET[:26] + ALPHABET[52:62], "base32": ALPHABET[26:52] + "234567"}


def ratio(model, token):
    at = [ALPHABET.index(c) for c in token]
    return sum(model[a * len(ALPHABET) + b] for a, b in zip(at, at[1:]))


def names(rng, n):
    out = []
    while len(out) < n:
        w = [rng.choice(WORDS) for _ in range(rng.randrange(2, 5))]
        t = rng.choice([w[0] + "".join(x.capitalize() for x in w[1:]), "_".join(w), "-".join(w), "_".join(w).upper(),
                        "_".join(w) + f"_v{rng.randrange(30)}", "_".join(w) + f"_{rng.randrange(2000, 2030)}"])
        if len(t) >= 16:
            out.append(t)
    return out


@pytest.fixture(scope="module")
def model(spark, make_docs):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(WORDS) for _ in range(20)) + f" token={''.join(rng.choices(ALPHABET[:62], k=30))}"
                f" {''.join(rng.choices('0123456789abcdef', k=40))} responsibilities administration") for i in range(50)]
    return secret_markov.train(make_docs([*docs, (90, None), (91, "")]))


def test_samples_and_probes_share_no_words():
    assert not set(WORDS) & set(secret_markov.NAME_WORDS)


def test_names_are_no_secrets_and_random_strings_are(model):
    rng = random.Random(2)
    flagged = sum(ratio(model, t) > LEAST_RATIO for t in names(rng, 500))
    caught = {k: sum(ratio(model, "".join(rng.choices(a, k=rng.randrange(16, 41)))) > LEAST_RATIO for _ in range(500))
              for k, a in ALPHABETS.items()}
    assert flagged <= 10, flagged
    assert all(n >= 450 for n in caught.values()), caught
    assert sum(caught.values()) / (sum(caught.values()) + flagged) > 0.98


def test_markov_spans_equal_spans_by_hand(model, make_docs):
    import re
    rng = random.Random(3)
    texts = [" ".join(rng.choice([rng.choice(WORDS), *names(rng, 1), "".join(rng.choices(ALPHABET[:62], k=rng.randrange(10, 40))),
                                  "\U0001f600é", "a" * 70]) for _ in range(40)) for _ in range(20)]
    found = {r.doc_id: [(s.start, s.end) for s in r.found if s.kind == 3]
             for r in secret_markov.find_secrets(make_docs(list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        assert found[i] == [m.span() for m in re.finditer(TOKEN.replace("}+", "}"), text) if ratio(model, m.group()) > LEAST_RATIO]
    assert any(found.values())


def test_identifiers_of_ones_own_and_empty_ones(spark, make_docs):
    own = spark.createDataFrame([("zqxzqxzqxzqxzqxzqx",), (None,), ("",), ("é é",)], "token string")
    empty = make_docs([(1, None)]).limit(0)
    taught, plain = (secret_markov.train(empty, ordinary=o) for o in (own, None))
    assert ratio(taught, "zqxzqxzqxzqxzqxzqx") < LEAST_RATIO < ratio(plain, "zqxzqxzqxzqxzqxzqx")
    assert set(secret_markov.train(empty, ordinary=own.limit(0))) == {0.0}
