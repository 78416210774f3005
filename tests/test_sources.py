import io
import zipfile

from pyspark.sql import functions as F

from threadline import dims
from threadline.functions import text as T
from threadline.operators import distributions
from threadline.sources import archives, exports, mapping


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


CHAT = "﻿preface\n5/8/23 9.05 - Ann B: hello\nsecond line\n\n05/08/23 09.06 - You joined\n05/08/23 09.07 - Desk: look (at: this)\r\n05/08/23 09.08 - Ann B: pic.JPG (file terlampir)\n05/08/23 09.09 - Ann B: <Media omitted>\n"


def test_parsing_folds_lines_and_finds_media(spark, tmp_path):
    write(tmp_path, "chat_1.txt", CHAT)
    write(tmp_path, "sub/chat_2.txt", "01/02/24 10.00 - Zoë: olé\n", "latin-1")
    write(tmp_path, "notes.txt", "nothing dated\n")
    lines = exports.read_exports(spark, str(tmp_path))
    rows = exports.with_ids(exports.fold_lines(lines)).orderBy("id").collect()
    assert [(r["id"], r["source_file"], r["sender"], r["text"], r["media_type"]) for r in rows] == [
        (1, "chat_1.txt", "Ann B", "hello\nsecond line", ""), (2, "chat_1.txt", "SYSTEM", "You joined", ""), (3, "chat_1.txt", "Desk", "look (at: this)", ""),
        (4, "chat_1.txt", "Ann B", "pic.JPG (file terlampir)", "image"), (5, "chat_1.txt", "Ann B", "<Media omitted>", "image"), (6, "chat_2.txt", "Zoë", "olé", ""),
    ]
    media = spark.createDataFrame([("chat_1", "pic.JPG", "m/pic.JPG"), ("chat_2", "pic.JPG", "x")], "chat string, file_name string, path string")
    assert [r["media_path"] for r in exports.attach_media(exports.fold_lines(lines), media).orderBy("source_file", "msg_no").collect()] == ["", "", "", "m/pic.JPG", "", ""]
    one = exports.parse_quality(exports.fold_lines(lines)).first()
    assert (one["messages"], one["files"], one["senders"], one["multi_line"], one["with_media"], one["system"]) == (6, 2, 4, 1, 2, 1)
    assert [(r["path"], r["timed_lines"], r["place"]) for r in exports.detect_chats(lines).orderBy("place").collect()] == [("chat_1.txt", 5, 1), ("chat_2.txt", 1, 2)]


def test_master_row_of_a_unit(spark):
    rows = [("c.txt", 1, "1/1/24", "9.00", "CLIENT", "the id 123 456 789 please", False), ("c.txt", 2, "1/1/24", "9.05", "ADMIN", "done\nnow", True), ("c.txt", 3, "1/1/24", "14.00", "CLIENT", "hello", False)]
    df = spark.createDataFrame(rows, "source_file string, msg_no int, sent_date string, sent_time string, role string, text string, has_media boolean")
    df = df.withColumn("ts", T.parse_chat_time(F.col("sent_date"), F.col("sent_time")))
    out = distributions.full_master(df, dims.TAXONOMY, T.word_pattern(("anydesk",)), T.credential_pattern(("id remote",)), T.word_pattern(("thanks",)), T.word_pattern(("wait",))).orderBy("sub_id").collect()
    assert [r["sub_id"] for r in out] == ["c_conv_001_a", "c_conv_002_a"]
    first = out[0]
    assert (first["total_messages"], first["client_messages"], first["admin_messages"], first["has_media"], first["has_credentials"], first["handling"], first["response"]) == (2, 1, 1, True, True, "REMOTE", "RESPONSE")
    assert first["transcript"] == "[2024-01-01 09:00:00] CLIENT: the id 123 456 789 please | [2024-01-01 09:05:00] ADMIN: done now"
    assert (out[1]["handling"], out[1]["response"], out[1]["has_credentials"]) == ("NON_REMOTE", "RESPONSE", False)
    scored = spark.createDataFrame([("c_conv_001_a", out[0]["category"], 0.9), ("c_conv_002_a", "x", 0.4)], "sub_id string, predicted string, confidence double")
    assert [r["match"] for r in distributions.with_prediction(spark.createDataFrame(out), scored).orderBy("sub_id").collect()] == ["MATCH", "DIFFER"]


def test_customer_names(spark):
    cases = {"WhatsApp Chat - Acme.txt": "Acme", "Obrolan WhatsApp dengan Toko  Maju.txt": "Toko Maju", "chat_12.txt": None, "a/WhatsApp Chat.txt": None, "Chat with Bo.zip": "Bo", "Acme Ltd.txt": "Acme Ltd", "x.txt": None, "data.txt": None, "": None}
    df = spark.createDataFrame(list(enumerate(cases)), "i int, name string")
    assert [r["c"] for r in df.select("i", T.customer_from_file(F.col("name")).alias("c")).orderBy("i").collect()] == list(cases.values())


def test_mapping_uses_paths_when_names_repeat(spark):
    chats = spark.createDataFrame([("1", "a/Acme.txt"), ("2", "b/Acme.txt")], "chat_id string, path string")
    assert [r["source_filename"] for r in mapping.chat_mapping(chats).orderBy("chat_id").collect()] == ["a/Acme.txt", "b/Acme.txt"]
    assert [r["source_filename"] for r in mapping.chat_mapping(chats.where("chat_id = '1'")).collect()] == ["Acme.txt"]
    old = spark.createDataFrame([("1", "x", "X"), ("3", "y", "Y")], "chat_id string, source_filename string, customer_name string")
    assert {r["chat_id"]: r["customer_name"] for r in mapping.merged_mapping(old, mapping.chat_mapping(chats)).collect()} == {"1": "Acme", "2": "Acme", "3": "Y"}
    assert [r["chat_id"] for r in mapping.numbered_chats(chats, 4).orderBy("path").collect()] == ["chat_5.txt", "chat_6.txt"]


def test_media_assignment(spark):
    media = spark.createDataFrame([("m/IMG 1.jpg",), ("a/two.pdf",), ("z/three.png",), ("z/readme.txt",)], "path string")
    lines = spark.createDataFrame([("A", "see img 1.JPG here"), ("B", "img 1.jpg too")], "chat_id string, line string")
    chats = spark.createDataFrame([("A", "a/x.txt", 1), ("B", "b/y.txt", 2)], "chat_id string, path string, place int")
    got = {r["path"]: (r["chat_id"], r["reason"]) for r in mapping.assign_media(chats, lines, media).collect()}
    assert got == {"m/IMG 1.jpg": ("A", "mentioned"), "a/two.pdf": ("A", "folder"), "z/three.png": (None, "unresolved")}
    alone = {r["path"]: r["reason"] for r in mapping.assign_media(chats.where("place = 2"), lines.where("chat_id = 'B'"), media).collect()}
    assert alone["z/three.png"] == "only_chat" and alone["a/two.pdf"] == "only_chat"


def packed(*members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name in members:
            z.writestr(name, "x" * 10)
    return out.getvalue()


def test_archives(spark, tmp_path):
    for name, content in {"good.zip": packed("a.txt", "b/c.jpg"), "up.zip": packed("../../a.txt"), "drive.zip": packed("C:\\a.txt"), "none.zip": packed("a.jpg"), "bad.zip": b"no archive", "big.zip": packed("a.txt", "b.txt", "c.txt")}.items():
        (tmp_path / name).write_bytes(content)
    members = archives.read_archives(spark, str(tmp_path))
    got = {r["path"].rsplit("/", 1)[1]: r["verdict"] for r in archives.judge_archives(members, max_unpacked=25).collect()}
    assert got == {"good.zip": "ok", "up.zip": "unsafe_member", "drive.zip": "unsafe_member", "none.zip": "no_text_file", "bad.zip": "not_an_archive", "big.zip": "unpacks_too_large"}


def test_rows_out_and_in(spark, tmp_path):
    df = spark.createDataFrame([("a", 'two\nlines, "quoted"'), ("b", None)], "k string, t string")
    exports.write_rows(df, f"{tmp_path}/out", ("t", "k"), single=True)
    assert {(r["k"], r["t"]) for r in exports.read_rows(spark, f"{tmp_path}/out", ("t", "k")).collect()} == {("a", 'two\nlines, "quoted"'), ("b", None)}
    lines = spark.createDataFrame([("f", 0, " one "), ("f", 1, ""), ("f", 2, "two")], "source_file string, line_no int, line string")
    assert [(r["line_no"], r["text"]) for r in exports.scoring_lines(lines).orderBy("line_no").collect()] == [(1, "one"), (3, "two")]


def test_sessions_never_fall_back(spark):
    master = spark.createDataFrame([(None, 1), ("s", 2)], "session_id string, x int")
    assert exports.session_rows(master, None).count() == 1 and exports.session_rows(master, "s").count() == 1
    try:
        exports.session_rows(master, "t")
        raise AssertionError("no error")
    except ValueError:
        pass
