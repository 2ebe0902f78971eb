from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from helpers import sentence  # noqa: E402


@pytest.fixture(scope="session")
def corpus():
    """Copies, edited copies, shared passages, repeats inside a text, short, blank, null and very long texts, odd white space."""
    rng = random.Random(11)
    texts = [sentence(rng, rng.choice([3, 5, 30, 80, 200])) for _ in range(40)]
    passage = sentence(rng, 60)
    for k in range(8):
        texts.append(sentence(rng, 20) + " " + passage + " " + sentence(rng, 15 + k))
    base = sentence(rng, 120).split()
    texts += [" ".join(base)] * 5
    for k in range(12):
        own = list(base)
        for _ in range(k // 2):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    texts += [None, "", " \t\n", "one", "One", "a b c d", "A B C D", "a b c d e", passage + " " + passage, "z " * 300, "ab" * 400, sentence(rng, 6000, 10**6)]
    texts += ["x\x0by\x0cz\n" + passage.replace(" ", "\t"), "l one\nl two\nl one\n\n \nl one", " nbsp stays " * 20]
    return list(enumerate(texts, 1))
