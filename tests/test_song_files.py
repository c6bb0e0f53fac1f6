"""Songs as text files: names, content, attempts that run twice or fail; A9 sees hidden files at any depth."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cadenza.sources.files import dir_size, read_messages
from cadenza.sources.songs import STAGING, SongWriter, read_songs, write_songs

ROWS = [("google/gpt", "my world", 1, "line one\nline two\n\né"), ("google/gpt", "my world", 2, "z"), ("m", "a+b%20c", 7, "x")]


def tree(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, files in os.walk(path) for f in files)


def test_files_have_the_songs_names_and_content(spark):
    path = os.path.join(tempfile.mkdtemp(), "songs")
    df = spark.createDataFrame(ROWS, "model string, name string, song_no long, content string").repartition(3)
    write_songs(df, path)
    with open(f"{path}/google_gpt/my world_song_1.txt", encoding="utf-8") as f:
        assert f.read() == ROWS[0][3]
    assert [t for t in tree(path) if not t.endswith(".crc")] == sorted(["_SUCCESS", "google_gpt/my world_song_1.txt", "google_gpt/my world_song_2.txt", "m/a+b%20c_song_7.txt"])
    got = sorted((r.folder, r.name, r.song_no, r.content) for r in read_songs(spark, path).collect())
    assert got == [("google_gpt", "my world", 1, ROWS[0][3]), ("google_gpt", "my world", 2, "z"), ("m", "a+b%20c", 7, "x")]
    write_songs(df, path)  # the same job again leaves one copy of each
    assert read_songs(spark, path).count() == 3


def rows(n):
    return [{"folder": "m", "file_name": f"n_song_{k}.txt", "content": f"song {k}"} for k in range(n)]


def test_an_attempt_that_runs_twice_leaves_one_copy():
    path = tempfile.mkdtemp()
    writer = SongWriter(path)
    first, again = writer.write(iter(rows(4))), writer.write(iter(rows(4)))
    writer.commit([again, None])
    assert first.songs == again.songs == 4
    assert tree(path) == ["_SUCCESS"] + [f"m/n_song_{k}.txt" for k in range(4)]


def test_a_failed_attempt_leaves_whole_songs_only_and_no_mark():
    path = tempfile.mkdtemp()
    writer = SongWriter(path)

    def broken():
        yield from rows(2)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(broken())
    writer.abort([None])
    assert tree(path) == ["m/n_song_0.txt", "m/n_song_1.txt"] and not os.path.exists(f"{path}/{STAGING}/{writer.job}")
    retry = SongWriter(path)
    retry.commit([retry.write(iter(rows(3)))])
    assert tree(path) == ["_SUCCESS"] + [f"m/n_song_{k}.txt" for k in range(3)]


def test_sizes_of_hidden_and_nested_files(spark):
    path = tempfile.mkdtemp()
    for name, size in (("a.txt", 3), (".hidden/_deep/x", 5), ("_tmp/.y", 7), ("empty/z", 0)):
        os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
        with open(f"{path}/{name}", "wb") as f:
            f.write(b"x" * size)
    assert tuple(dir_size(spark, path).first()) == (15, 4)
    assert tuple(dir_size(spark, tempfile.mkdtemp()).first()) == (0, 0)


def test_a_chat_export_of_many_lines_is_one_document(spark):
    path = tempfile.mkdtemp()
    with open(f"{path}/c.json", "w", encoding="utf-8") as f:
        f.write('{\n "messages": [\n  {"text": "one\\ntwo"},\n  {"text": 3},\n  {"text": ""}\n ]\n}\n')
    assert [(r.msg_no, r.text) for r in read_messages(spark, path).orderBy("msg_no").collect()] == [(0, "one\ntwo"), (2, "")]
