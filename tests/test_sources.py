import json

from pyspark.sql import functions as F

from reviewloom.plans import etl, report
from reviewloom.sources import sinks, tables


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_etl_from_raw_files(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    business = [
        {"business_id": "a", "name": "A", "city": "x", "state": "s", "stars": 4.0, "review_count": 3,
         "categories": ["Restaurants", "Bars"], "attributes": {"Good For (lunch)": "yes", "Price=Range": "2"}},
        {"business_id": "b", "name": "B", "city": "x", "state": "s", "stars": 2.5, "review_count": 1,
         "categories": ["Shops"], "attributes": {}},
        {"business_id": "c", "name": "C", "city": "y", "state": "s", "stars": 3.0, "review_count": 0,
         "categories": [], "attributes": None},
        {"business_id": "d", "name": "D", "city": "y", "state": "s", "stars": 3.0, "review_count": 0,
         "categories": ["Fast Restaurants"], "attributes": {}},
    ]
    lines = lambda rows: "\n".join(json.dumps(r) for r in rows)
    write(raw / "business.json", lines(business))
    write(raw / "checkin.json", lines([{"business_id": "a", "checkin_info": {"9-5": 2, "7-5": 1}},
                                       {"business_id": "b", "checkin_info": {"1-1": 5}}]))
    write(raw / "tip.json", lines([{"business_id": "b", "text": "t"}]))
    votes = {"funny": 1, "useful": 2, "cool": 0}
    write(raw / "review.json", lines([
        {"review_id": f"r{i}", "business_id": b, "user_id": "u", "stars": 4, "date": "2015-02-03", "text": "ok",
         "type": "review", "votes": votes} for i, b in enumerate("aab")]))
    write(raw / "photo.json", json.dumps([{"business_id": "a", "photo_id": "p1"}, {"business_id": "b", "photo_id": "p2"}]))
    etl.restaurant_etl(spark, str(raw), str(out))
    read = lambda name: spark.read.parquet(str(out / f"{name}.parquet"))
    assert {r.business_id for r in read("business").collect()} == {"a", "d"}
    assert read("business_cleaned").filter("business_id = 'a'").first().attributes == {"Good_For__lunch_": "yes", "Price_Range": "2"}
    assert read("business_category").count() == 4
    assert [read(n).count() for n in ("checkin", "tip", "review", "photo")] == [1, 0, 2, 1]
    assert {(r.business_id, r.total_checkins) for r in read("total_checkins").collect()} == {("a", 3), ("b", 5)}


def test_table_handle_is_reused(spark, sf):
    assert tables.open_table(spark, f"{sf}/part.parquet") is tables.open_table(spark, f"{sf}/part.parquet")


def test_search_lines(spark):
    df = spark.createDataFrame(
        [("Joe's", "1", "x", "s", 3.5, 7, ["Bars", "Pubs"]), ("Zoe", "2", "y", "t", 4.0, 1, [])],
        "name string, business_id string, city string, state string, stars double, review_count long, categories array<string>")
    whole = sinks.join_lines(sinks.format_search(df)).first().result
    assert whole == 'Joe\'s;1;x;s;3.5;7;"Bars" "Pubs" |Zoe;2;y;t;4.0;1;'


def test_text_dir(spark, tmp_path):
    write(tmp_path / "a" / "one.txt", "first\nfile")
    write(tmp_path / "b" / "two.txt", "second")
    got = {r.file_name.split("/test_text_dir0/")[-1]: r.text for r in tables.read_text_dir(spark, str(tmp_path)).collect()}
    assert got == {"a/one.txt": "first\nfile", "b/two.txt": "second"}


def test_report_of_a_business_without_reviews_or_checkins(spark):
    business = spark.createDataFrame([("a", "A", "x", "s"), ("b", "B", "x", "s")], "business_id string, name string, city string, state string")
    review = spark.createDataFrame(
        [("r1", "a", "u", 5, "2016-01-01", "great tacos"), ("r2", "a", "v", 1, "2016-01-03", "cold tacos")],
        "review_id string, business_id string, user_id string, stars int, date string, text string",
    ).withColumn("date", F.to_date("date")).withColumn("votes", F.expr("named_struct('funny', 0L, 'useful', 1L, 'cool', 0L)"))
    checkin = spark.createDataFrame([("a", {"9-5": 2})], "business_id string, checkin_info map<string,bigint>")
    rows = {r.business_id: r for r in report.report({"business": business, "review": review, "checkin": checkin}).collect()}
    assert json.loads(rows["a"].review_count_series) == {"date": ["2016-01-01", "2016-01-02", "2016-01-03"], "review_count": [1, 1, 2]}
    assert rows["a"].checkins == 2 and rows["b"].checkins == 0
    assert rows["b"].review_count_series is None and rows["b"].overlap is None
    assert {w["word"] for w in json.loads(rows["a"].top_words_all)} == {"great", "cold", "tacos"}
    telling = json.loads(rows["a"].telling_words)
    assert telling["good"][0]["word"] == "great" and telling["bad"][-1]["word"] == "cold"


def test_topics_are_probabilities_and_repeatable(spark):
    from reviewloom.operators import topics

    rows = [(i, w, 1 + (i + j) % 3) for i in range(60) for j, w in enumerate(("a b", "c d", "e f", "g h")) if (i + j) % 2]
    dtm = spark.createDataFrame(rows, "review_id int, term string, n long")
    review = spark.createDataFrame([(i, f"b{i % 3}", 3) for i in range(60)], "review_id int, business_id string, stars int")
    runs = []
    for _ in range(2):
        fitted = topics.fit_topics(dtm, 2, seeds=[5, 63], iterations=5, subsample=1.0)
        runs.append(sorted(map(tuple, topics.topic_probs(fitted, dtm, review).collect())))
    assert runs[0] == runs[1]
    for row in runs[0]:
        assert abs(sum(row[4:]) - 1) < 1e-9 and row[3] == 1 + max(range(2), key=lambda i: row[4 + i])
    assert topics.topic_terms(fitted, 2, wide=True).columns == ["rank", "Topic 1", "Topic 2"]
