import os

import pytest
from pyspark.sql import functions as F

from skeinwork.llm import langid as L

SF = "/root/testdata/sf0.01/documents.parquet"

GERMAN = "der die das und nicht ist mit ein auf für von den sich auch wird Straße größer über Häuser schön"
ENGLISH = "the and of with that this have from they would there their what about which when people great house"
FRENCH = "le la les des est dans pour qui que sur avec être été déjà français où garçon leçon élève même"
SPANISH = "el los las una por para con está más pero también niño año señor qué cómo mañana corazón aquí"
TEXTS = {"de": GERMAN, "en": ENGLISH, "fr": FRENCH, "es": SPANISH}


def rows():
    out = []
    for lang, text in TEXTS.items():
        own = text.split()
        out += [(" ".join(own[(i * 7 + k * 3) % len(own)] for k in range(12)), lang) for i in range(30)]
    return out


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.createDataFrame(rows() + [(None, "en"), ("", "de"), ("123 !?", "fr"), ("text", None)], "text string, lang string"))


def test_families_come_before_languages(model):
    assert model.families == ["germanic", "romance"]
    assert model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"]}


def test_texts_without_letters_are_undetermined(spark, model):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 ?!"), (None, "für die Straße und das Haus"), (5, "x" * 3_000_000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.identify(docs.withColumn("score", F.lit(3)), model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[1]["score"] == 0
    assert got[None]["lang_pred"] == "de" and 0 <= got[5]["score"] <= 1
    kept = L.keep_identified(docs.withColumn("_lang_found", F.lit(1)), model)
    assert [r["doc_id"] for r in kept.collect()] == [None]  # letters that are no language go as well
    assert kept.columns == ["doc_id", "text", "_lang_found"]


def test_pieces_of_long_texts_count_like_a_whole():
    text = (GERMAN + " ") * 20_000
    assert abs(L.features(text) - L.features((GERMAN + " ") * 100)).max() < 0.005  # one piece


def test_the_sample_is_bounded_and_no_language_is_left_out(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(L, "fit_svm", lambda x, y: seen.append(len(x)) or L.np.zeros(x.shape[1] + 1))
    docs = spark.createDataFrame(rows() * 3 + [(f"word{i} of language {i}", f"l{i:03d}") for i in range(40)], "text string, lang string")
    few = L.fit(docs, rows=10, total=88)
    assert sum(map(len, few.languages.values())) == 44 and max(seen) == 4 * 2 + 40


def test_marks_alone_are_no_letters():
    assert L.features("\u0301\u0302 \u0903") is None and L.features("1\u0301") is None
    assert L.features("e\u0301") is not None and (L.features("e\u0301 \u0301") == L.features("e\u0301  ")).all()
    assert (L.features("cafe\u0301") != L.features("cafe")).any()


def test_repeated_rows_stay(spark, model):
    docs = spark.createDataFrame([(1, GERMAN), (1, GERMAN), (None, GERMAN), (None, GERMAN)], "doc_id long, text string")
    assert [(r["lang_pred"], r["held_out"]) for r in L.identify(docs, model).collect()].count(("de", False)) == 4


def test_a_plain_vote_gives_the_same_languages(model):
    for text in [t for t, _ in rows()] + [GERMAN + ENGLISH, "xyz", "ß"]:
        x = L.np.append(L.features(text).astype(float), 1.0)
        family = max(range(len(model.families)), key=lambda i: float(model.family_weights[i] @ x))
        names = model.languages[model.families[family]]
        wins = [0] * len(names)
        for (a, b), w in zip(model.pairs[model.families[family]], model.pair_weights[model.families[family]]):
            wins[a if w @ x >= 0 else b] += 1
        assert model.predict(text)[0] in [n for n, k in zip(names, wins) if k == max(wins)]


def test_one_language_or_none(spark):
    one = L.fit(spark.createDataFrame([("hello there", "en")], "text string, lang string"))
    assert one.predict("whatever")[0] == "en" and one.predict("7")[0] == "und"
    none = L.fit(spark.createDataFrame([], "text string, lang string"))
    assert none.predict("whatever") == ("und", 0.0)


FOREIGN = {
    "ru": "Москва является столицей и крупнейшим городом страны на реке", "ru, one word": "Привет", "ja": "日本語の文章は漢字とひらがなとカタカナで書かれている", "el": "Η Αθήνα είναι η πρωτεύουσα και η μεγαλύτερη πόλη της χώρας",
    "ar": "القاهرة هي عاصمة البلاد", "zh": "北京是中华人民共和国的首都", "ko": "서울은 대한민국의 수도이다", "junk": "qzxv kjwq zzzx", "more junk": "xqzj vvkq wxzqj kqqz jjxw " * 40, "none": "12 34 !!",
}


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
@pytest.mark.skipif(not os.path.exists(SF), reason="needs the driver's tables")
def test_other_languages_and_junk_go_and_no_text_of_a_language_learned(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet").filter("lang IS NOT NULL AND text RLIKE '[A-Za-z]'")
    model = L.fit(docs.filter(~L.held_out("doc_id")))
    assert L.keep_identified(docs, model).count() == docs.count()
    others = spark.createDataFrame(list(FOREIGN.items()), "doc_id string, text string")
    assert [r["doc_id"] for r in L.keep_identified(others, model).collect()] == []


def test_a_language_of_one_text_takes_what_is_nearest_to_it(spark):
    model = L.fit(spark.createDataFrame([(GERMAN, "de"), (ENGLISH, "en")], "text string, lang string"))
    assert model.like(GERMAN, "de") >= 1 and model.like("ganz andere Wörter", "de") >= 1 and model.like("x", "und") == 0 and model.like(None, "de") == 0


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the driver's tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF)
    model = L.fit(docs.filter(~L.held_out("doc_id")))
    got = L.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 200 and right / n > 0.98


def test_a_language_of_many_copies_is_learned(spark, monkeypatch):
    """30 distinct texts a language, 400 copies each: with 10 rows asked for, the smallest ten hashes of each are taken."""
    seen = []
    monkeypatch.setattr(L, "fit_svm", lambda x, y: seen.append(len(x)) or L.np.zeros(x.shape[1] + 1))
    distinct = len({t for t, lang in rows() if lang == "de"})
    docs = spark.createDataFrame(rows(), "text string, lang string").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(400))))
    model = L.fit(docs, rows=10)
    assert distinct >= 10 and model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert seen == [40, 40, 20, 20]
