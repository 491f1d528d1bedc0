"""What the secret scan's models say of ordinary names, paths, dates and numbers, and of random strings of several lengths."""

import base64
import random
import string

import pytest
from pyspark.sql import functions as F

from costlake.llm import secrets

SF = "/root/testdata/sf0.01"
# words that are none of the training's
OTHER = (
    "mountain river basket silver garden travel pencil orange doctor bridge kitchen forest market ticket winter summer captain shadow lantern thunder village harvest "
    "candle copper velvet meadow rocket planet harbor saddle walnut ribbon tunnel blanket compass feather granite horizon journey"
).split()
NAMED = [
    "https/example-site/get/count-json", "src/main/resources/templates/index", "/usr/local/share/applications/default-settings", "2024-01-05-backup-of-the-server", "MAX_RETRY_COUNT_EXCEEDED",
]


@pytest.fixture(scope="module")
def weights(spark):
    return secrets.train(secrets.labelled_samples(spark.read.parquet(f"{SF}/documents.parquet")))


def is_secret(token, weights):
    size, before, total = len(secrets.ALPHABET) + 1, 0, 0.0
    for c in token:
        here = secrets.ALPHABET.index(c) + 1
        total += weights[before * size + here]
        before = here
    return len(token) >= 8 and total >= max(secrets.MIN_TOTAL, secrets.MIN_MEAN * len(token))


def test_ordinary_shapes_are_let_be(weights):
    rng = random.Random(9)
    some = lambda apart, n=0: apart.join(rng.choice(OTHER) for _ in range(n or rng.randrange(3, 6)))
    digits = lambda n: "".join(rng.choice(string.digits) for _ in range(n))
    camel = lambda: "".join(w.title() for w in some(" ").split())
    shapes = {
        "path": lambda: "/" + some("/"), "url": lambda: "https/" + some("-", 2) + "/get/" + some("-", 2), "kebab": lambda: some("-"), "snake": lambda: some("_"),
        "constant": lambda: some("_").upper(), "camel": camel, "lower camel": lambda: rng.choice(OTHER) + camel(), "dated": lambda: f"20{digits(2)}-03-1{digits(1)}-{some('-')}",
        "phone": lambda: f"{digits(3)}-{digits(3)}-{digits(4)}", "card": lambda: "-".join(digits(4) for _ in range(4)), "numbered": lambda: rng.choice(OTHER) + digits(4),
    }
    shapes |= {f"{n} digits": lambda n=n: digits(n) for n in (10, 12, 13, 16, 20)}
    for name, make in shapes.items():
        assert sum(is_secret(make(), weights) for _ in range(500)) <= 10, name
    assert not [t for t in NAMED if is_secret(t, weights)]


def test_random_strings_are_found(weights):
    rng = random.Random(10)
    kinds = {
        "base64": lambda n: base64.b64encode(rng.randbytes(n)).decode()[:n], "hex": lambda n: rng.randbytes(n).hex()[:n],
        "letters and digits": lambda n: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n)),
        "upper case": lambda n: "".join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(n)),
    }
    for name, make in kinds.items():
        for n, least in ((12, 0.9), (20, 0.98), (32, 0.99)):
            assert sum(is_secret(make(n), weights) for _ in range(500)) >= 500 * least, (name, n)


def test_no_number_of_the_table_is_a_secret(spark, weights):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = secrets.scan(docs, weights).select(F.explode(F.filter("_secrets", lambda s: s["kind"] == "markov")).alias("s"))
    assert found.where(F.col("s.match").rlike("^[0-9-]+$")).isEmpty() and found.count() == 0
