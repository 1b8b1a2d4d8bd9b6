import numpy as np
import pytest
from pyspark.sql import functions as F

from tillbook.llm.langid import BITS, CENTROIDS, Model, clusters, held_out, identify, learn, size_limits, term_counts
from tillbook.llm.queries import op10_language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = op10_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    test = [r for r in got if r["held_out"]]
    assert 0.15 < len(test) / len(got) < 0.25
    assert sum(r["lang"] == r["lang_pred"] for r in test) / len(test) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got) and {r["lang_pred"] for r in got} <= {"en", "de", "fr", "es"}
    assert sum(r["rejected"] for r in got) <= 0.005 * len(got)


def test_held_out_rows_are_those_of_crc32(spark):
    import zlib
    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)
    assert spark.sql("select cast(null as long) as id").select(held_out(F.col("id")).alias("h")).first()["h"] is False


def test_nearest_centroid_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = learn(docs, F.lit(True), sample=20)
    unit = model.centroids.T / np.linalg.norm(model.centroids.T, axis=1, keepdims=True)
    for r in docs.limit(40).collect():
        vector = np.zeros(len(model.idf))
        at, counts = term_counts(r["text"])
        vector[at] = (1 + np.log(counts)) * model.idf[at]
        cosine = unit @ (vector / np.linalg.norm(vector))
        lang, score, _ = model.predict(r["text"])
        assert lang == model.languages[int(cosine.argmax())] and score == pytest.approx(cosine.max(), abs=1e-4)


def test_clusters():
    rng = np.random.default_rng(2)
    centre = np.eye(6)[:3]
    rows = np.vstack([c + rng.normal(0, 0.05, (30, 6)) for c in centre])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    found, lowest = clusters(rows, 3)
    assert sorted((found @ centre.T).argmax(axis=1)) == [0, 1, 2] and (found @ centre.T).max(axis=1).min() > 0.99
    assert lowest.min() == pytest.approx((rows @ found.T).max(axis=1).min())
    assert len(clusters(np.ones((5, 4)) / 2, 3)[0]) == 1


def test_far_text_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = learn(docs, F.lit(True), sample=200)
    assert model.predict("".join(chr(0x4E00 + i * 7) for i in range(600)))[2]
    assert not any(model.predict(r["text"])[2] for r in docs.limit(200).collect())


FOREIGN = {
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności zawarte w niniejszej Deklaracji bez względu na różnice rasy, koloru, płci, języka, wyznania, poglądów politycznych i innych przekonań",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokainen on oikeutettu kaikkiin tässä julistuksessa esitettyihin oikeuksiin ja vapauksiin ilman minkäänlaista rotuun, väriin, sukupuoleen, kieleen, uskontoon perustuvaa erotusta",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler. Herkes, ırk, renk, cinsiyet, dil, din, siyasi veya başka bir akide, milli veya içtimai menşe, servet, doğuş farkı gözetilmeksizin",
    "hu": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek. Mindenki, bármely megkülönböztetésre tekintet nélkül hivatkozhat a jelen Nyilatkozatban kinyilvánított összes jogokra és szabadságokra",
}
CLEAN = ["The children went to school in the morning.", "We will meet again after the summer.", "Die Kinder gehen heute in die Schule.",
         "Der Zug nach Berlin kommt später.", "Les enfants sont dans la maison.", "Nous avons mangé avec nos amis.",
         "Los niños van a la escuela por la mañana.", "Hello", "Guten Tag", "thank you"]


def test_foreign_and_random_texts_are_rejected(spark):
    import random
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = learn(docs, F.lit(True))
    for text in FOREIGN.values():
        words = text.split()
        for n in (16, 32, len(words)):
            assert model.predict(" ".join(words[:n]))[2], (n, text)
    for seed in range(30):
        rng = random.Random(seed)
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) for _ in range(400)]
        assert all(model.predict(" ".join(words[:n]))[2] for n in (40, 400))
    assert not any(model.predict(text)[2] for text in CLEAN)
    assert model.predict("日本語のテキスト")[2]


def test_one_odd_document_moves_no_limit():
    rng = np.random.default_rng(3)
    cosines = rng.normal(0.8, 0.03, 400)
    clean = size_limits(np.full(400, 600), cosines)
    odd = size_limits(np.full(401, 600), np.r_[cosines, 0.01])
    assert clean[-1] > 0.2 and odd[-1] > 0.2 and not clean[:-1].any()


def test_hard_rows(docs_of):
    rows = [(1, None), (2, ""), (3, "123 !? 45"), (None, "the cat and the dog"), (5, "ab"), (5, "ab"), (6, "the " * 50_000), (7, "a1b2 x9"), (8, "日本語")]
    labelled = docs_of([(i, ("the cat and the dog is here " if i % 2 else "der hund und die katze ist da ") * 3 + str(i)) for i in range(40)]
                       + [(100, None), (101, "1 2 3"), (102, "")]).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").when(F.col("doc_id") < 90, "de"))
    model = learn(labelled, F.lit(True))
    assert set(model.languages) == {"de", "en"}
    out = identify(docs_of(rows), model).select("doc_id", "lang_pred", "score", "rejected").collect()
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows) and all(by[i]["lang_pred"] == "und" and by[i]["rejected"] and by[i]["score"] == 0 for i in (1, 2, 3))
    assert by[None]["lang_pred"] == by[6]["lang_pred"] == "en" and by[8]["lang_pred"] in ("de", "en")
    assert identify(docs_of([]).where("false"), model).collect() == []
    empty = learn(labelled.where("false"), F.lit(True))
    assert isinstance(empty, Model) and empty.predict("the cat") == ("und", 0.0, True)
    only_null = learn(labelled.where("doc_id >= 100").withColumn("lang", F.lit("en")), F.lit(True))
    assert only_null.predict("the cat")[0] == "und"


def test_more_languages_than_a_model_holds(docs_of, table, monkeypatch):
    monkeypatch.setattr("tillbook.llm.langid.MODEL_BYTES", 2 * 4 * CENTROIDS << BITS)
    rows = [(i, f"word{i} and more words of it", ["en", "en", "en", "de", "de", f"odd {i}"][i % 6]) for i in range(60)]
    model = learn(table(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert set(model.languages) == {"de", "en"}
