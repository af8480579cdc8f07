"""Texts of 50 MB: each operator's row functions stay under 1 GB of memory."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
MOST_MB = 1000
MAKE = """
import resource, sys, time
import numpy as np
import pyarrow as pa
sys.path.insert(0, {root!r})
rng = np.random.default_rng(1)
words = [b"".join(bytes([97 + c]) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(5000)]
def text(kind):
    if kind == "word":
        return b"x-y" * 17_000_000
    out = b" ".join(words[i] for i in rng.integers(0, 5000, 1_000_000).tolist())
    return (out + b" ") * (50_000_000 // len(out))
"""
CASES = {
    "fingerprint": "from lexmill.llm.simhash import fingerprint; fingerprint(text(kind))",
    "shingle_set": "from lexmill.llm.near_copies import shingle_set; shingle_set(text(kind))",
    "decontaminate": "from lexmill.llm.decontaminate import Items, batch_hits; items = Items([(1, b' '.join(words[:40]))], 15, 0.8); list(batch_hits(items, pa.array([text(kind).decode()])))",
    "langid": """
from lexmill.llm import langid
names = ["a", "b", "c", "d"]
model = langid.Model(names, np.log(rng.random((langid.BUCKETS, 4))).astype(np.float32), np.zeros((len(langid.SCRIPT_NAMES), 4), np.float32))
langid.labelled(pa.array([text(kind).decode()]), model)
""",
    "chat": "from lexmill.llm.chat import assemble; t = pa.array([text(kind).decode()]); assemble([pa.array(['a']), t, pa.array(['b'])])",
    "packing": "from lexmill.llm import packing; list(packing.encoded([text(kind)], packing.WordTokens(packing.TOKENIZER)))",
    "katz": """
from lexmill.llm import katz
for p in katz.pieces(text(kind), 2):
    path, _, _ = katz.write_block("/tmp", pa.array([1]), np.array([False]), [p])
    b = katz.Block(path)
    own = np.bincount(b.tokens, minlength=len(b.hashes))
    g = katz.Grams(b.tokens, own, np.arange(len(own)), np.full(len(b.tokens), 10**8))
    for _ in range(2):
        q = katz.Questions(b, katz.Grams(b.tokens, own, np.arange(len(own)), g.norm), g, 9, 8, 500_000)
        list(q.bodies(np.bincount(q.place, minlength=q.size)))
        g = katz.Grams(q.place, np.bincount(q.place, minlength=q.size), np.arange(q.size), g.norm)
    import os
    os.remove(path)
""",
    "classifier": """
from lexmill.llm import quality_classifier as q
for part in q.slices(text(kind).decode()):
    for _, b in q.bucket_runs(q.code_points(part)):
        np.bincount(b, minlength=q.BUCKETS)
""",
}


@pytest.mark.parametrize("kind", ["words", "word"])
@pytest.mark.parametrize("name", CASES)
def test_memory(name, kind):
    if (name, kind) == ("packing", "word"):
        pytest.skip("the tokenizer itself takes a word whole")
    end = "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)"
    code = MAKE.format(root=ROOT) + f"kind = {kind!r}\n" + CASES[name] + "\n" + end
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-800:]
    assert int(done.stdout) < MOST_MB
