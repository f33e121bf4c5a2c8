import duckdb
from pyspark.ml.feature import HashingTF

from textmark.queries import sql as S


def test_hash_in_sql_is_the_vectoriser_s(spark):
    """Every length of the tail, signs of one to four bytes, the empty term."""
    terms = ["", "a", "ab", "abc", "abcd", "abcde", "żółć", "日本語", "😀", "zażółć gęślą jaźń", "x" * 257]
    places = HashingTF(numFeatures=1 << 18)
    listed = ", ".join(f"('{term}')" for term in terms)
    sql = f"WITH {S.hashed_places(f'SELECT * FROM (VALUES {listed}) t(term)', 1 << 18)} SELECT term, bucket FROM murmur"
    found = dict(duckdb.sql(sql).fetchall())
    assert found == {term: places.indexOf(term) for term in terms}
