"""Large groups of like texts: the pairs that ``minhash`` confirms on full sets, and the links it finds."""

from calforge.llm import minhash as M


def _near(spark, rows, monkeypatch):
    """Rows by id, and how many pairs each call of ``confirmed`` was given."""
    given, whole = [], M.confirmed

    def counted(pairs, classes, docs):
        given.append(pairs.count())
        return whole(pairs, classes, docs)

    monkeypatch.setattr(M, "confirmed", counted)
    out = M.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    return {r["doc_id"]: r for r in out}, given


def test_crowd_below_threshold_is_not_confirmed_pair_by_pair(spark, monkeypatch):
    """60 texts with a similarity of 0.71 to each other make 1,770 pairs, none a link. The last two are linked."""
    shared = " ".join(f"w{i}" for i in range(504))
    rows = [(n, shared + " " + " ".join(f"t{n}x{i}" for i in range(103))) for n in range(60)]
    rows.append((60, rows[59][1] + " and a few more words"))
    found, given = _near(spark, rows, monkeypatch)
    assert {n: r["component_id"] for n, r in found.items()} == {n: min(n, 59) for n in range(61)}
    assert sum(given[2:]) < 500


def test_linked_crowd_equals_brute_force(spark, monkeypatch):
    """Texts that drop other words of one long text: near the threshold, some linked and some not."""
    words = [f"w{i}" for i in range(400)]
    rows = []
    for n in range(70):
        cut = {(n * 37 + j * 53 + j * j * (n % 7)) % 400 for j in range(6 + n % 9)}
        rows.append((n, " ".join(f"x{n}" if i in cut else w for i, w in enumerate(words))))
    sets = {n: {tuple(t.split()[i:i + 5]) for i in range(396)} for n, t in rows}
    links = [(a, b) for a in sets for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = {n: n for n in sets}
    for _ in sets:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found, _ = _near(spark, rows, monkeypatch)
    assert {n: r["component_id"] for n, r in found.items()} == root
    assert 5 < len(set(root.values())) < 65
