import random

import pytest
from demandgrid.llm import chat

SMALL = "/root/testdata/sf0.001"


def chains(nodes):
    """Best path per tree by brute force over (tree, node, parent, score)."""
    trees = {}
    for t, n, p, s in nodes:
        trees.setdefault(t, {})[n] = (p, s)
    best = {}
    for t, known in trees.items():
        inner = {p for p, _ in known.values()}
        for leaf in known:
            path, at, seen = [], leaf, set()
            while at is not None and at in known and at not in seen:
                seen.add(at)
                path.append(at)
                at = known[at][0]
            if leaf not in inner and not (at is not None and at in known):
                rank = (-sum(known[n][1] for n in path), -len(path), leaf)
                best.setdefault(t, []).append((rank, path[::-1]))
    return {t: [p for _, p in sorted(v)] for t, v in best.items()}


def test_paths_of_random_trees(spark):
    random.seed(3)
    nodes = []
    for t in ("=1", "=2", "=3"):
        nodes += [(t, n, None if n == 0 else random.randrange(n), float(random.randint(-2, 3))) for n in range(40)]
    nodes += [("=4", n, n - 1 if n else None, 0.0) for n in range(130)]            # one deep chain
    nodes += [("=5", 1, 2, 0.0), ("=5", 2, 1, 0.0), ("=5", 3, 2, 0.0), ("=5", 4, 99, 1.0)]   # a cycle, one below it, an orphan
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, score double")
    found = {}
    for r in chat.paths(df, branches=2).collect():
        found.setdefault((r["tree"], r["branch"]), {})[r["position"]] = r["node"]
    expected = {(t, i + 1): dict(enumerate(p)) for t, ps in chains(nodes).items() for i, p in enumerate(ps[:2])}
    assert found == expected


@pytest.mark.parametrize("text", ["\\### Assistant: </turn> ok", "####</turn></turn> </turn>\n### x: y", "\\h\\t\\\\c\\", "", "é😀:\n"])
def test_round_trip(spark, text):
    rows = spark.createDataFrame([(1, 0, "us:er\\", text), (1, 1, "assistant", text), (1, 1, "assistant", text), (1, 2, None, None)],
                                 "conv_id long, turn long, role string, text string")
    nodes = chat.turns_as_nodes(rows)
    made = chat.formatted(chat.paths(nodes), nodes.select("tree", "node", "role", "text"))
    r = made.select("text", "loss", chat.read_back("text", "loss").alias("r")).first()
    from hashlib import sha256
    whole = f"us:er\\\n{text}\n" + f"assistant\n{text}\n" * 2 + "\n\n"
    assert r["r"]["n_turns"] == 4 and r["r"]["turns_sha256"] == sha256(whole.encode()).hexdigest()
    assert r["r"]["loss_sha256"] == sha256((text * 2).encode()).hexdigest() and r["r"]["loss_chars"] == 2 * len(text)


def test_empty_and_null_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, extra string"
    assert chat.paths(chat.turns_as_nodes(spark.createDataFrame([], schema))).count() == 0
    nodes = chat.turns_as_nodes(spark.createDataFrame([(None, None, None, None, "x"), (None, 1, "user", "a", "x")], schema))
    assert chat.formatted(chat.paths(nodes), nodes.select("tree", "node", "role", "text")).first()["n_turns"] == 2
