import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Extra columns carry names that operators might use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row int, h string, size string"


def texts():
    rng = random.Random(5)
    voc = "the of and to in ore thand erinth Ontion, stesh. heed anin été ñar über 漢字 12 #x |".split()
    base = [" ".join(rng.choices(voc, k=rng.randint(30, 200))) for _ in range(25)]
    near = []
    for t in base[:12]:
        words = t.split()
        words[rng.randrange(len(words))] = "zzz"
        near += [" ".join(words), t.replace(" ", "\n", 3), t + " "]
    odd = [None, "", " \t\n", "a", "A b", "a\tB", "x\x0by\x0cz", "a b c", "same line\nsame line\nother\nsame line", "😀 é́ 漢",
           "Contact une.92@mail6.example.com or +49 (170) 123-4567, host 10.0.0.255, card 4111 1111 1111 1111!",
           "bad 300.1.1.1 and 4111111111111112 and +1 2", "This work is licensed under the GNU General Public License, version 3.",
           "intro\nReleased under the MIT License!\nend", "<|endoftext|> it's <|start", "word " * 9000, "7" * 20000]
    return base + near + odd


def rows():
    out = [(i, t, ("en", "fr", None)[i % 3], ("b", "a", None, "c")[i % 4], 1, False, 0, "h", "s") for i, t in enumerate(texts())]
    return out + out[:3] + [(None, "lost id one two three", "en", "a", None, None, None, None, None)] * 2


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else (text or ""))
