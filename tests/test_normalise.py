from threadline.functions import text as T

DOMAIN, GENERAL, PROTECTED = {"nt": "net", "eror": "error"}, {"gk": "not", "ok": "okay", "bisa": "can"}, ("the", "aaa")
#: What becomes of each word.
EXPECTED = {
    "nt": "net", "nttt": "net", "eror": "error", "errror": "error", "erooor": "error", "gkkk": "not", "gk": "not", "ok": "okay", "okkk": "okay", "ookkk": "ook", "bisa": "can", "bisaaa": "can", "the": "the", "theee": "the",
    "thhhe": "the", "aaa": "aaa", "aaaa": "a", "xyz": "xyz", "plain": "plain", "words": "words", "aabbb": "aab",
}


def test_cascade_against_a_table_of_words(spark):
    texts = [" ".join(EXPECTED), "", None, "okkk  nttt plain words", "the aaa xyz"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    out = {r["i"]: (r["normalised"], r["changed"]) for r in T.normalised_texts(df, "c", DOMAIN, GENERAL, PROTECTED).collect()}
    for i, text in enumerate(texts):
        words = None if text is None else text.split()
        assert out[i] == ((None, None) if words is None else (" ".join(EXPECTED[w] for w in words), sum(w != EXPECTED[w] for w in words)))
