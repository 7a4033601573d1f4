import re

import duckdb
import pytest

from loomline.llm.pairs import KINDS, Exact, canon, defects, is_empty, made_pairs, train, unmarked

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def sound():
    c = duckdb.connect()
    rows = c.execute(
        f"""SELECT any_value(j.english), any_value(coalesce(j.japanese, '')), t.vietnamese FROM '{DATA}/story_translations.parquet' t
        JOIN '{DATA}/story_job.parquet' j ON j.key = t.key AND j."sourceHash" = t."sourceHash"
        WHERE t.status IN ('LOCAL_OK', 'REVIEW') AND length(t.vietnamese) > 8 GROUP BY t.seq, t.vietnamese ORDER BY t.seq"""
    ).fetchall()
    return rows


def test_held_out_accuracy(sound):
    model = train(sound[:1500])
    clean = [p for p, k in zip(sound[1500:2200], model.kinds(sound[1500:2200]), strict=True) if k is None]
    assert len(clean) > 0.85 * len(sound[1500:2200])
    made = made_pairs(clean, 99)
    kinds = model.kinds([m[:3] for m in made])
    for label in ("refusal", "copied", "wrong_language", "truncated"):
        hit = sum(k == label for k, m in zip(kinds, made, strict=True) if m[3] == label)
        said = sum(k == label for k in kinds)
        n = sum(m[3] == label for m in made)
        right = sum(k == label and m[3] == label for k, m in zip(kinds, made, strict=True))
        assert hit / n > 0.9, label
        assert right / said > 0.9, label


# None of these languages and wordings is in the training data.
UNSEEN = """
fi|He saapuivat kaupunkiin liian myöhään eikä kukaan odottanut heitä.|Ikkuna pitää sulkea ennen kuin sade alkaa.|Tie on pitkä mutta meillä on ruokaa kaikille.
sv|De kom för sent till staden och ingen väntade på dem.|Man måste stänga fönstret innan det börjar regna.|Vägen är lång men vi har mat till alla.
cs|Přišli do města příliš pozdě a nikdo na ně nečekal.|Musíš zavřít okno, než začne pršet.|Cesta je dlouhá, ale máme jídlo pro všechny.
ro|Au ajuns prea târziu în oraș și nimeni nu îi aștepta.|Trebuie să închizi fereastra înainte să plouă.|Drumul este lung, dar avem mâncare pentru toți.
sw|Walifika mjini wakiwa wamechelewa na hakuna aliyewasubiri.|Lazima ufunge dirisha kabla mvua haijaanza.|Njia ni ndefu lakini tuna chakula cha wote.
hu|Túl későn értek a városba, és senki sem várt rájuk.|Be kell csukni az ablakot, mielőtt elered az eső.|Az út hosszú, de mindenkinek van étele.
hi|वे शहर में बहुत देर से पहुँचे और कोई उनका इंतज़ार नहीं कर रहा था।|बारिश शुरू होने से पहले खिड़की बंद करनी होगी।
ar|وصلوا إلى المدينة متأخرين ولم يكن أحد ينتظرهم.|يجب إغلاق النافذة قبل أن يبدأ المطر.
el|Έφτασαν πολύ αργά στην πόλη και κανείς δεν τους περίμενε.|Πρέπει να κλείσεις το παράθυρο πριν βρέξει.
"""
REFUSALS = [
    "I'm afraid I cannot help you translate that.", "Sorry, I can't do this translation.", "I am unable to translate the given passage because of my policy.", "As an AI, I must refuse to translate this text.",
    "Unfortunately, translating this content is not permitted, so I have to decline.", "Rất xin lỗi, mình không thể hỗ trợ dịch đoạn này.", "Tôi buộc phải từ chối dịch văn bản này.", "Xin thứ lỗi, tôi không được phép dịch câu này.",
    "Là trợ lý AI, tôi không thể dịch nội dung như vậy.", "Yêu cầu này vi phạm chính sách nên tôi từ chối dịch.",
]


def test_unseen_languages_and_refusals(sound):
    model = train(sound[:1800])
    told = [p for p, k in zip(sound[1800:2000], model.kinds(sound[1800:2000]), strict=True) if k is None]
    missed = {}
    for line in UNSEEN.strip().splitlines():
        name, *texts = line.split("|")
        kinds = model.kinds([(en, jp, t) for t in texts for en, jp, _ in told])
        missed[name] = kinds.count("wrong_language") / len(kinds)
    print(missed)
    assert min(missed.values()) >= 0.9
    kinds = [model.kinds([(en, jp, t) for en, jp, _ in told]).count("refusal") / len(told) for t in REFUSALS]
    print(kinds)
    assert sum(kinds) / len(kinds) >= 0.9


def test_empty_answers():
    for v in ("", " ", "…", "“”", "N/A", "null", "(trống)", "[empty]", "​", None):
        assert is_empty(v or "")
    assert not is_empty("Có")
    assert unmarked("Đường về") == "Duong ve"
    assert canon("A-b 1!") == "ab1"


def test_few_or_no_pairs(spark, sound):
    assert isinstance(train([]), Exact)
    log = spark.createDataFrame([(1, "k", "h", None), (2, "k", "h", "go NOW"), (3, "k", "x", ""), (4, None, "h", ""), (5, "k", "h", None)], "seq bigint, key string, sourceHash string, vietnamese string")
    lines = spark.createDataFrame([("k", "h", "Go now.", None, "x"), ("k", "h", "Go now.", None, "x")], "key string, sourceHash string, english string, japanese string, vietnamese string")
    got = sorted(map(tuple, defects(log, lines, "seq", "vietnamese", ["key", "sourceHash"], "english", "japanese").collect()))
    assert got == [(1, "empty"), (2, "copied"), (5, "empty")]
    assert defects(log.limit(0), lines, "seq", "vietnamese", ["key", "sourceHash"], "english", "japanese").count() == 0


def test_kinds_and_long_texts(spark, sound):
    model = train(sound[:1500])
    en, jp, vi = next(p for p in sound if len(p[2]) > 150 and model.kinds([p]) == [None])
    long = (" ".join([en] * 200), "", " ".join([vi] * 200))
    assert model.kinds([long]) == [None]
    assert model.kinds([(long[0], "", long[2][: len(long[2]) // 3])]) == ["truncated"]
    assert model.kinds([(en, jp, en.upper())]) == ["copied"]
    assert model.kinds([(en, jp, "Xin lỗi, tôi không thể dịch nội dung này.")]) == ["refusal"]
    assert model.kinds([(en, jp, f"{re.search('[A-Z][a-z]+ [A-Z][a-z]+', vi).group(0)} caminaba por la noche sin decir una palabra y la gente miraba.")]) == ["wrong_language"]
    assert model.kinds([(en, jp, unmarked(vi))]) == [None]
    assert set(KINDS) >= {"empty"}
