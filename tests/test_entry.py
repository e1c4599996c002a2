import __spark_entry__ as entry


def test_entry_flagship(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["release_year", "genre_name", "movie_count", "avg_popularity",
                          "avg_rating", "total_movies_per_year", "genre_market_share"]


def test_query_names_match_sql_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
