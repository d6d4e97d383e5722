"""JDBC options. No database is started, so nothing is transferred here."""

from candlewick.sources.jdbc import ReadRange, read_jdbc, read_options, write_jdbc


class Recorder:
    """Stands in for a frame or session and notes the calls made on its reader or writer."""

    def __init__(self):
        self.calls = []
        self.read = self.write = self

    def __getattr__(self, name):
        def note(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return note


URL = "jdbc:vendor://host/db"


def test_plain_read_options():
    assert read_options(URL, "t") == {"url": URL, "dbtable": "t", "preferTimestampNTZ": "true"}


def test_divided_read():
    session = Recorder()
    read_jdbc(session, URL, "t", ReadRange("timestamp", "2024-01-01", "2024-02-01", 31), fetchsize="10000")
    options = session.calls[1][2]
    assert [name for name, *_ in session.calls] == ["format", "options", "load"]
    assert options["partitionColumn"] == "timestamp" and options["numPartitions"] == "31"
    assert options["lowerBound"] == "2024-01-01" and options["upperBound"] == "2024-02-01"
    assert options["fetchsize"] == "10000"


def test_append_is_the_default():
    frame = Recorder()
    write_jdbc(frame, URL, "t")
    assert ("mode", ("append",), {}) in frame.calls
    assert frame.calls[-1][0] == "save"


def test_overwrite_passes_options_through():
    frame = Recorder()
    write_jdbc(frame, URL, "t", "overwrite", createTableOptions="engine=Memory", truncate="true")
    assert ("mode", ("overwrite",), {}) in frame.calls
    assert ("options", (), {"url": URL, "dbtable": "t", "createTableOptions": "engine=Memory", "truncate": "true"}) in frame.calls
