"""Settings handed to connectors this environment lacks, seen through stand-ins."""

from unittest.mock import MagicMock

from wardline.config import StreamConfig
from wardline.sources.messages import message_writer
from wardline.streaming import ingest, replay


def recorder(options):
    """Answers every builder call with itself and notes options."""
    builder = MagicMock()
    for call in ("format", "outputMode"):
        getattr(builder, call).return_value = builder
    builder.option.side_effect = lambda key, value: options.update({key: value}) or builder
    return builder


CONFIG = StreamConfig(kafka_bootstrap="b:1", kafka_topic="t", pg_host="db", pg_table="target", pg_user="u", pg_password="p")


def test_kafka_writer():
    options, messages = {}, MagicMock()
    messages.writeStream = recorder(options)
    message_writer(messages, CONFIG, "/cp")
    messages.writeStream.format.assert_called_once_with("kafka")
    messages.writeStream.outputMode.assert_called_once_with("append")
    assert options == {"checkpointLocation": "/cp", "kafka.bootstrap.servers": "b:1", "topic": "t"}


def test_kafka_batches():
    options, messages = {}, MagicMock()
    messages.write = recorder(options)
    replay.kafka_emit(CONFIG)(messages, 3)
    assert options == {"kafka.bootstrap.servers": "b:1", "topic": "t"}
    messages.write.save.assert_called_once_with()


def test_database_pages():
    rows = MagicMock()
    ingest.jdbc_sink(CONFIG)(rows, 7)
    (url, table), named = rows.write.jdbc.call_args
    assert (url, table, named["mode"]) == ("jdbc:postgresql://db:5432/database", "target", "append")
    assert named["properties"]["batchsize"] == "500" and named["properties"]["user"] == "u"
