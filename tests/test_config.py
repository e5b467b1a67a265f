import pytest

from tagtide.config import KafkaSettings, Settings, SparkSettings, session
from tagtide.sinks.kafka import kafka_sink_options
from tagtide.sources.feeds import kafka_source_options
from tagtide.workspace import checkpointed, new_path, shared_dir


def test_defaults():
    settings = Settings()
    assert settings.feed.language == "en" and settings.feed.min_reposts == 100
    assert settings.feed.posts_to_collect == 100
    assert settings.spark.batch_seconds == 5 and settings.tables.time_zone == "Europe/Amsterdam"
    assert settings.tables.days_back == 1


def test_toml(tmp_path):
    file = tmp_path / "settings.toml"
    file.write_text('[feed]\nlanguage = "fr"\nmin_reposts = 5\n[spark]\nshuffle_partitions = 400\n')
    settings = Settings.from_toml(str(file))
    assert settings.feed.language == "fr" and settings.feed.min_reposts == 5
    assert settings.spark.shuffle_partitions == 400
    assert settings.kafka == KafkaSettings()


def test_unknown_key_is_refused():
    with pytest.raises(TypeError):
        Settings().override({"feed": {"nothing": 1}})
    with pytest.raises(AttributeError):
        Settings().override({"nowhere": {}})


def test_from_session(spark):
    spark.conf.set("tagtide.feed.min_reposts", "7")
    spark.conf.set("tagtide.kafka.brokers", "a:1,b:2")
    try:
        settings = Settings.from_session(spark)
        assert settings.feed.min_reposts == 7 and settings.kafka.brokers == "a:1,b:2"
    finally:
        spark.conf.unset("tagtide.feed.min_reposts")
        spark.conf.unset("tagtide.kafka.brokers")


def test_session_takes_over_the_running_one(spark):
    taken = session(Settings(spark=SparkSettings(shuffle_partitions=8)))
    assert taken.sparkContext is spark.sparkContext
    assert taken.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    assert taken.conf.get("spark.sql.session.timeZone") == "UTC"


def test_records_per_batch():
    settings = Settings().override({"kafka": {"records_per_batch": "5000"}}).kafka
    assert kafka_source_options(settings)["maxOffsetsPerTrigger"] == "5000"


def test_kafka_options():
    settings = KafkaSettings()
    one = kafka_source_options(settings)
    assert one == {
        "kafka.bootstrap.servers": "localhost:9092",
        "kafka.group.id": "G1",
        "startingOffsets": "latest",
        "subscribe": "reposts",
    }
    assert kafka_source_options(settings, ["a", "b"])["subscribe"] == "a,b"
    pattern = kafka_source_options(settings, pattern="re.*")
    assert pattern["subscribePattern"] == "re.*" and "subscribe" not in pattern
    assert kafka_sink_options(settings) == {
        "kafka.bootstrap.servers": "localhost:9092",
        "kafka.acks": "1",
        "topic": "reposts",
    }


def test_workspace_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    assert new_path(spark, "x").startswith(named) and new_path(spark, "x") != new_path(spark, "x")
    df = checkpointed(spark.range(5))
    assert df.count() == 5 and "ExistingRDD" in df._jdf.queryExecution().toString()
