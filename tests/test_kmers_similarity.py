"""k-mers, Jaccard, length filter and buckets on the hand-made rows of FIXTURES.md."""

from pyspark.sql import functions as F

from kmerscope.functions.kmers import with_kmers
from kmerscope.functions.similarity import jaccard, length_bucket, length_ratio_ok, log_length_band

KMER_CASES = [
    (None, [], []),
    ("", [], []),
    ("ab", [], []),
    ("aaaa", ["aaa", "aaa"], ["aaa"]),
    ("MKAL", ["MKA", "KAL"], ["MKA", "KAL"]),
    ("éabc", ["éab", "abc"], ["éab", "abc"]),
    ("😀xyz", ["😀xy", "xyz"], ["😀xy", "xyz"]),
    ("a\nbc", ["a\nb", "\nbc"], ["a\nb", "\nbc"]),
]


def test_kmer_bag_and_set(spark):
    df = spark.createDataFrame([(s,) for s, _, _ in KMER_CASES], "s string")
    df = with_kmers(df, "s", "bag", 3, distinct=False)
    df = with_kmers(df, "s", "set", 3, distinct=True)
    got = {r["s"]: (r["bag"], r["set"]) for r in df.collect()}
    for s, bag, st in KMER_CASES:
        assert got[s][0] == bag
        assert sorted(got[s][1]) == sorted(st)


def test_codes_are_injective_and_match_strings(spark):
    rows = [("x" + s,) for s in ["abcabc", "éé😀é", "zzz", "a\nb\nc"]]
    df = spark.createDataFrame(rows, "s string")
    df = with_kmers(df, "s", "ks", 3, distinct=True, encoding="string")
    df = with_kmers(df, "s", "kc", 3, distinct=True, encoding="code")
    for r in df.collect():
        assert len(r["ks"]) == len(r["kc"])
        expect = {(ord(k[0]) << 42) + (ord(k[1]) << 21) + ord(k[2]) for k in r["ks"]}
        assert set(r["kc"]) == expect


def test_jaccard_values(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["a", "b", "d"]), (["a"], ["a"]), (["a"], ["b"]),
                                ([], ["a"]), ([], [])], "a array<string>, b array<string>")
    got = [r[0] for r in df.select(jaccard("a", "b")).collect()]
    assert got == [0.5, 1.0, 0.0, 0.0, 0.0]


LENGTH_CASES = [(20, 26, False), (20, 15, False), (20, 18, True), (20, 22, True), (100, 90, True),
                (100, 111, True), (100, 89, False), (100, 112, False), (0, 0, False)]


def test_ratio_filter_table(spark):
    df = spark.createDataFrame([(a, b) for a, b, _ in LENGTH_CASES], "a int, b int")
    got = [r[0] for r in df.select(length_ratio_ok("a", "b", 0.1)).collect()]
    assert got == [keep for _, _, keep in LENGTH_CASES]


def test_length_bucket(spark):
    df = spark.createDataFrame([(n,) for n in [0, 99, 100, 199, 200]], "n int")
    assert [r[0] for r in df.select(length_bucket("n", 100)).collect()] == [0, 0, 1, 1, 2]


def test_log_band_adjacent_for_every_passing_pair(spark):
    lengths = list(range(1, 400))
    df = spark.createDataFrame([(n,) for n in lengths], "n int").select("n", log_length_band("n", 0.1).alias("b"))
    band = {r["n"]: r["b"] for r in df.collect()}
    for a in lengths:
        for b in lengths:
            if abs(a - b) / max(a, b) <= 0.1:
                assert abs(band[a] - band[b]) <= 1, (a, b)
