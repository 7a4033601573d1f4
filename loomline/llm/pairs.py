"""Problem 2: broken source-answer pairs.

A multi-label linear classifier on hashed word n-grams of the answer and on
features of the pair.  It is trained here, on defects made from a bounded sample
of sound pairs: answers cut short, copies of the source in other formatting,
answers swapped for text in another language, and refusals.  Every label's
threshold is calibrated on made pairs that the training did not see.

The sample is the ``SAMPLE`` pairs of the lowest hash of their identifier, so it
is the same on every run; real defects in it are removed by a first model.  All
pairs of the log are scored, whole texts, in one map over Arrow batches.

So that answers in any language are told, most of the text in other languages is
made: the pair's own texts with their letters exchanged within vowels and
consonants, with foreign marks, or written in another script (``disguised``).
Refusals are known by their words alone, so they always keep their n-grams, while
half of the other pairs go without, and a text of unknown words is no refusal.

``empty`` is exact: nothing but spaces and signs, or a word that stands for a
missing value.  Scores are calibrated to probabilities on the held-out made pairs;
a kind needs one of a half as well as its threshold.  A pair gets the first kind
that applies, in the order of KINDS.

Defined cases: null columns count as ''; an answer is compared with both source
texts in either column; a very long text is read whole; repeated log rows are
repeated in the result; with fewer than ``LEAST`` sound pairs there is nothing to
train on, so only ``empty`` and exact copies come out; empty tables give no row.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.operators.skew import many_to_one
from loomline.session import ship

KINDS = ("empty", "refusal", "copied", "wrong_language", "truncated")
LABELS = KINDS[1:]
SAMPLE, LEAST, DIM, EPOCHS, BATCH = 3000, 50, 1 << 15, 12, 512
#: Where in the gap between the classes a threshold lies.
GAP = 0.35
#: Part of the sound answers that a known word stands in.
KNOWN = 0.006

# Words that stand for a missing value, letters and digits only.
STAND_IN = frozenset("null none nil na nan empty undefined missing blank trống rỗng khôngcó chưacó chưadịch tbd todo trong rong khongco なし 空 無し なし 空白 未翻訳 없음 无 空白 notavailable notranslation novalue nodata notext".split())

_LETTERS = re.compile(r"[^\W_]+")
#: Runs of Latin letters and digits, and runs of other letters.
_TOKENS = re.compile(r"[A-Za-z0-9\u00C0-\u024F\u1E00-\u1EFF]+|[^\W_A-Za-z0-9\u00C0-\u024F\u1E00-\u1EFF]+")
_TERMINAL = tuple(".!?。！？…♪")
_CUT = re.compile(r"(?:\[\s*(?:\.\.\.|…)\s*\]|\(\s*(?:\.\.\.|…)?|\.\.\.|…|[-–—,:;/|&])\s*$")
_END = "”’\"'»)]』」*_ \t\r\n　​﻿\xa0 "
_MARKUP = re.compile(r"<[^<>\r\n]*>|\{[^{}\r\n]*\}|%\d*\$?[-+#0']*\d*(?:\.\d+)?[a-zA-Z]")
_VIET = re.compile("[ăâđêôơưàằầèềìòồờùừỳảẳẩẻểỉỏổởủửỷãẵẫẽễĩõỗỡũữỹáắấéếíóốớúứýạặậẹệịọộợụựỵ]")
# A Vietnamese syllable without its marks: onset, nucleus, coda.
_SYLLABLE = re.compile(r"(?:ngh|ng|nh|gh|gi|kh|ph|qu|th|tr|ch|[bcdghklmnpqrstvx])?(?:uye|uyu|oai|oay|uay|uoi|uou|ieu|yeu|oeo|uya|ai|ao|au|ay|eo|eu|ia|ie|iu|oa|oe|oi|oo|ua|ue|ui|uo|uu|uy|ye|[aeiouy])(?:ch|nh|ng|[cmnpt])?")

# Short texts in other languages; {n} is a name of the line.
_OTHER = """
es|Llegaron tarde a la ciudad y nadie los esperaba.|{n} no quiere hablar de lo que pasó ayer.|Hay que cerrar la ventana antes de que empiece a llover.|Dale estas cartas a {n} cuando vuelva del mercado.|El camino es largo pero tenemos comida para todos.|Nadie conoce el secreto que guarda {n} en su casa.|Solo podemos entrar si la llave es la correcta.|Mi amigo espera junto al río desde la mañana.
fr|Ils sont arrivés trop tard dans la ville et personne ne les attendait.|{n} ne veut pas parler de ce qui est arrivé hier.|Il faut fermer la fenêtre avant que la pluie commence.|Donne ces lettres à {n} quand il revient du marché.|Le chemin est long mais nous avons des vivres pour tous.|Personne ne sait ce que {n} garde chez lui.|On ne peut entrer qu'avec la bonne clé.|Mon ami attend au bord de la rivière depuis ce matin.
de|Sie kamen zu spät in der Stadt an und niemand wartete auf sie.|{n} will nicht über das sprechen, was gestern geschehen ist.|Man muss das Fenster schließen, bevor der Regen beginnt.|Gib {n} diese Briefe, wenn er vom Markt zurückkommt.|Der Weg ist lang, aber wir haben genug Vorräte für alle.|Die Tür öffnet sich nur mit dem richtigen Schlüssel.
it|Sono arrivati tardi in città e nessuno li aspettava.|{n} non vuole parlare di quello che è successo ieri.|Bisogna chiudere la finestra prima che cominci a piovere.|Consegna queste lettere a {n} quando torna dal mercato.|La strada è lunga ma abbiamo provviste per tutti.
pt|Eles chegaram tarde à cidade e ninguém os esperava.|{n} não quer falar sobre o que aconteceu ontem.|É preciso fechar a janela antes que comece a chover.|Entregue estas cartas a {n} quando voltar do mercado.|O caminho é longo mas temos comida para todos.
id|Mereka datang terlambat ke kota dan tidak ada yang menunggu.|{n} tidak mau berbicara tentang apa yang terjadi kemarin.|Kita harus menutup jendela sebelum hujan turun.|Berikan surat ini kepada {n} ketika dia kembali dari pasar.|Jalannya panjang tetapi kami sudah menyimpan bekal untuk semua orang.|Pintu itu hanya bisa dibuka dengan kunci yang benar.|Tak seorang pun tahu rahasia yang disimpan {n} di rumahnya.|Temanku menunggu di tepi sungai sejak pagi.
tl|Huli na silang dumating sa bayan at walang naghihintay.|Ayaw pag-usapan ni {n} ang nangyari kahapon.|Isara mo ang bintana bago umulan.|Ibigay mo ang mga sulat na ito kay {n} pagbalik niya mula sa palengke.
nl|Zij kwamen te laat in de stad aan en niemand wachtte op hen.|{n} wil niet praten over wat er gisteren gebeurde.|Je moet het raam sluiten voordat het gaat regenen.|De weg is lang maar we hebben genoeg eten voor iedereen.
pl|Przybyli zbyt późno do miasta i nikt na nich nie czekał.|{n} nie chce rozmawiać o tym, co stało się wczoraj.|Trzeba zamknąć okno, zanim zacznie padać.|Droga jest długa, ale mamy zapasy dla wszystkich.
tr|Şehre çok geç geldiler ve onları bekleyen kimse yoktu.|{n} dün olanlar hakkında konuşmak istemiyor.|Yağmur başlamadan önce pencereyi kapatmak gerekir.|Yol uzun ama herkes için yiyeceğimiz var.
ru|Они пришли в город слишком поздно, и никто их не ждал.|{n} не хочет говорить о том, что случилось вчера.|Нужно закрыть окно, пока не начался дождь.|Дорога длинная, но у нас хватит еды на всех.
zh|他们很晚才到城里，没有人等他们。|{n}不想谈昨天发生的事情。|下雨之前必须把窗户关上。|等{n}从市场回来的时候，请把这些信交给他。|路很长，但是我们准备了足够的食物。
ko|그들은 도시에 너무 늦게 도착했고 아무도 기다리지 않았다.|{n}은 어제 일어난 일에 대해 말하고 싶어하지 않는다.|비가 오기 전에 창문을 닫아야 한다.|길은 멀지만 모두를 위한 식량이 있다.
th|พวกเขามาถึงเมืองช้าเกินไปและไม่มีใครรออยู่|{n} ไม่อยากพูดถึงสิ่งที่เกิดขึ้นเมื่อวาน|ต้องปิดหน้าต่างก่อนฝนจะตก|ทางยาวแต่เรามีอาหารสำหรับทุกคน
ja|彼らは町に着くのが遅すぎて、誰も待っていなかった。|{n}は昨日起きたことを話したがらない。|雨が降る前に窓を閉めなければならない。|道は長いが、皆の食料はある。
en|They reached the town too late and no one waited for them.|{n} does not want to talk about what happened yesterday.|You have to close the window before the rain starts.|Hand these letters to {n} once the market is over.|The road is long, but there is food for everybody.|Whenever {n} comes by, that gate opens at once.
"""

# Ways in which an assistant declines, as choices that are combined.
_REFUSE = {
    "en": (
        "I'm sorry, but |I am sorry, |Sorry, but |I apologize, but |Unfortunately |Unfortunately, ||As an AI language model, |My apologies, |I regret that |Please understand, ",
        "I can't |I cannot |I won't be able to |I'm unable to |I am not able to |I must decline to |I'm not allowed to |I have to refuse to ",
        "translate |help with translating |provide a translation of |assist with |complete the translation of |process |give a version of ",
        "this text|this content|this passage|this line|that request|this sentence|the source text",
        ".|!| for safety reasons.| due to my guidelines.|. Please provide another text.|. Let me know if I can help with something else.| because it violates the policy.",
    ),
    "en2": ("I'm sorry, |Sorry, |Unfortunately |", "this request |this content |this text |translating this passage ", "violates |is against |goes against |is not allowed by ", "my guidelines|the content policy|our safety rules|my instructions", ".|, so I can't translate it.|. Please provide a different text."),
    "vi": (
        "Xin lỗi, |Xin lỗi nhưng |Tôi xin lỗi, |Tôi xin lỗi nhưng |Rất tiếc, |Rất tiếc nhưng |Thành thật xin lỗi, ||Là một mô hình ngôn ngữ, |Tôi rất tiếc, |Mong bạn thông cảm, ",
        "tôi không thể |tôi không được phép |tôi không có khả năng |tôi từ chối |tôi xin phép không |hệ thống không thể |tôi chưa thể |mình không thể ",
        "dịch |hỗ trợ dịch |thực hiện |hoàn thành |cung cấp bản dịch cho |đáp ứng |xử lý |hỗ trợ |trả lời ",
        "nội dung này|đoạn văn này|đoạn văn bản này|văn bản này|câu này|yêu cầu này|yêu cầu dịch thuật này|bản dịch này|phần này",
        ".|!| vì lý do an toàn.|. Vui lòng cung cấp văn bản khác.|. Bạn có thể gửi câu khác không?| theo chính sách.| do vi phạm quy định.",
    ),
    "vi2": ("Xin lỗi, |Tôi xin lỗi nhưng |Rất tiếc, |", "nội dung này |yêu cầu này |đoạn văn này |văn bản này ", "không phù hợp |vi phạm chính sách |không được cho phép |vi phạm nguyên tắc an toàn ", "để tôi dịch|nên tôi không thể dịch|nên tôi không thể hỗ trợ|để dịch thuật", ".|!| vì lý do an toàn.|. Vui lòng cung cấp văn bản khác."),
    "vi3": ("Rất tiếc, |Xin lỗi, |Tôi xin lỗi nhưng |", "tôi là một mô hình ngôn ngữ |tôi là trợ lý AI |tôi chỉ là một chương trình ", "và không thể |nên không thể |và không được phép ", "hoàn thành bản dịch|dịch nội dung này|thực hiện yêu cầu", ".|!|. Vui lòng cung cấp văn bản khác.|. Bạn có thể gửi câu khác không?"),
    "ja": ("申し訳ありませんが、|申し訳ございません。|恐れ入りますが、|すみませんが、|残念ながら、|", "この文章は|この内容は|このご依頼には|この内容の翻訳は|この翻訳は|ご依頼の文は", "翻訳できません|お応えできません|お手伝いできません|対応できません|お受けできません|お断りします|訳すことができません", "。|。別の文章をお送りください。|。ポリシーに反するためです。|。ご了承ください。"),
    "zh": ("抱歉，|很抱歉，|对不起，|", "我无法|我不能|我没有办法|作为语言模型，我无法", "翻译|处理|完成|提供", "这段内容|这个请求|该文本|这句话的翻译", "。|。请提供其他文本。|，因为它违反了政策。"),
    "ko": ("죄송하지만 |죄송합니다. |", "이 내용을 |이 요청을 |이 문장을 |이 번역을 ", "번역할 수 없습니다|도와드릴 수 없습니다|수행할 수 없습니다|처리할 수 없습니다", ".|. 다른 문장을 보내 주세요."),
    "es": ("Lo siento, pero |Lo siento, |Disculpe, |", "no puedo |no me es posible |no tengo permitido ", "traducir |ayudar con |procesar ", "este texto|esta traducción|esta solicitud", ".|. Envíe otro texto."),
    "fr": ("Je suis désolé, mais |Désolé, |", "je ne peux pas |il m'est impossible de ", "traduire |traiter |répondre à ", "ce texte|cette demande|ce contenu", ".|. Veuillez fournir un autre texte."),
    "de": ("Es tut mir leid, aber |Leider |", "ich kann |kann ich ", "diesen Text nicht übersetzen|bei dieser Anfrage nicht helfen|diesen Inhalt nicht bearbeiten", ".|. Bitte senden Sie einen anderen Text."),
    "en3": ("That is not something |This is not something |Translating this is not something |", "I can do for you|I am able to help with|I'm permitted to translate|I can assist you with", ".|!|. Please try a different text.| as an assistant."),
    "ru": ("К сожалению, |Извините, но |Простите, |", "я не могу |я не имею права |мне нельзя ", "перевести |обработать |помочь с переводом ", "этот текст|этого содержимого|эту строку", ".|. Пожалуйста, пришлите другой текст."),
    "th": ("ขออภัย |ขอโทษ ", "ฉันไม่สามารถ|เราไม่สามารถ|ผมไม่สามารถ", "แปล|ช่วยแปล|ดำเนินการกับ", "ข้อความนี้|เนื้อหานี้|คำขอนี้", "| กรุณาส่งข้อความอื่น"),
    "pt": ("Desculpe, |Lamento, mas |", "não posso |não consigo ", "traduzir |ajudar com |processar ", "este texto|este conteúdo|este pedido", ".|. Envie outro texto."),
    "it": ("Mi dispiace, |Spiacente, |", "non posso |non riesco a ", "tradurre |elaborare ", "questo testo|questa richiesta|questo contenuto", ".|. Invia un altro testo."),
    "id": ("Maaf, |Mohon maaf, |", "saya tidak dapat |saya tidak bisa ", "menerjemahkan |membantu |memproses ", "teks ini|permintaan ini|konten ini", ".|. Silakan kirim teks lain."),
}
_REFUSE = {k: [part.split("|") for part in v] for k, v in _REFUSE.items()}


def plain(text: str | None) -> str:
    return unicodedata.normalize("NFC", text or "")


def canon(text: str) -> str:
    return "".join(_LETTERS.findall(text.lower()))


def is_empty(answer: str) -> bool:
    c = canon(answer)
    return not c or c in STAND_IN


def unmarked(text: str) -> str:
    """Without diacritics, as Vietnamese is often typed."""
    t = unicodedata.normalize("NFD", text.replace("đ", "d").replace("Đ", "D"))
    return unicodedata.normalize("NFC", "".join(ch for ch in t if not unicodedata.combining(ch)))


def _latin(text: str) -> int:
    return sum(1 for ch in text if ch < "ɐ")


def _dice(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    x, y = Counter(zip(a, a[1:])), Counter(zip(b, b[1:]))
    n = len(a) + len(b) - 2
    return 2 * sum(min(v, y[k]) for k, v in x.items() if k in y) / n if n else 0.0


def _ends(text: str) -> bool:
    return text.rstrip(_END).endswith(_TERMINAL)


def _stops(text: str) -> int:
    return len(re.findall(r"[.!?。！？]+", text)) or 1


def _fields(text: str) -> int:
    return len(re.findall(r"[:：=＝]", text))


class Features:
    """Pair features and hashed n-grams; knows the words of sound answers and the
    usual lengths of answers."""

    #: Features, and the place of the share of known words.
    DENSE, SHARE = 34, 4

    def __init__(self, sound: list[tuple[str, str, str]]):
        seen: Counter[str] = Counter()
        per_latin, per_other = [], []
        for en, jp, vi in sound:
            source = set(_TOKENS.findall((en + " " + jp).lower()))
            seen.update({w for x in (vi.lower(), unmarked(vi.lower())) for w in _TOKENS.findall(x)} - source)
            a = len(canon(vi))
            for s in (en, jp):
                c = canon(s)
                if len(c) >= 15:
                    (per_latin if _latin(c) * 2 > len(c) else per_other).append(a / len(c))
        # The sample has some defects itself: the few answers of one other language
        # must not make its words known.
        least = max(3, int(KNOWN * len(sound)))
        self.known = frozenset(w for w, n in seen.items() if n >= least)
        self.cache: dict[str, tuple[bool, bool, bool]] = {}
        self.per_latin = float(np.median(per_latin)) if per_latin else 1.0
        self.per_other = float(np.median(per_other)) if per_other else 2.3

    def word(self, w: str) -> tuple[bool, bool, bool]:
        """Whether a word is known, shaped like a syllable, and marked."""
        got = self.cache.get(w)
        if got is None:
            if len(self.cache) > 200_000:
                self.cache.clear()
            got = self.cache[w] = (w in self.known, bool(_SYLLABLE.fullmatch(unmarked(w))), bool(_VIET.search(w)))
        return got

    def of(self, en: str, jp: str, vi: str) -> tuple[list[int], list[float], float]:
        """Hashed indexes, dense features, copy score."""
        clean = _MARKUP.sub(" ", vi)
        tokens = _TOKENS.findall(clean.lower())
        by_field = [_TOKENS.findall(x.lower()) for x in (en, jp)]
        source = set(by_field[0]).union(by_field[1])
        rest = [w for w in tokens if w not in source and not w.isdigit()]
        c, ce, cj = canon(vi), canon(en), canon(jp)
        n, letters = len(rest), sum(map(len, rest)) or 1
        other = sum(len(w) for w in rest if w[0] > "\u024f" and not "\u1e00" <= w[0] <= "\u1eff") / letters
        copy = 1.0 if c in (ce, cj) else 0.0
        if not copy:
            have = Counter(tokens)
            for field in by_field:
                if len(field) >= 2 and abs(len(field) - len(tokens)) <= 0.5 * len(field):
                    both = sum(min(k, have[w]) for w, k in Counter(field).items() if w in have)
                    copy = max(copy, 2 * both / (len(field) + len(tokens)))
            if any(ch > "\u2fff" for ch in c):
                copy = max(copy, _dice(c, cj), _dice(c, ce))
            # A copy that lost its end is a copy still.
            if len(c) >= 12 and (ce.startswith(c) or cj.startswith(c)):
                copy = max(copy, 0.97)
        traits = [(len(w), *self.word(w)) for w in rest]
        known = sum(k for k, a, _, _ in traits if a) / letters if n else 0.5
        shaped = sum(k for k, _, a, _ in traits if a) / letters if n else 0.5
        marked = sum(k for k, _, _, a in traits if a) / letters if n else 0.5
        latin_source = next((s for s in (ce, cj) if s and _latin(s) * 2 > len(s)), "")
        other_source = next((s for s in (ce, cj) if s and _latin(s) * 2 <= len(s)), "")
        expected = len(latin_source) * self.per_latin if latin_source else len(other_source) * self.per_other
        ratio = float(np.log((len(c) + 1) / (expected + 1)))
        long = min(1.0, expected / 100)
        short = max(0.0, -ratio)
        s_text = en if latin_source and latin_source is ce else (jp if latin_source else en or jp)
        ends, s_ends = _ends(vi), _ends(en) or _ends(jp)
        cut = bool(_CUT.search(vi.rstrip(" \t\r\n\u3000\xa0")[-8:]))
        digits, have = [w for w in source if w.isdigit()], set(tokens)
        recall = sum(w in have for w in digits) / len(digits) if digits else 1.0
        stops = min(2.0, _stops(clean) / _stops(s_text))
        nf = _fields(s_text)
        fields = min(1.0, _fields(vi) / nf) if nf >= 2 else 1.0
        shared = sum(w in source for w in tokens) / max(1, len(tokens))
        dense = [
            1.0, copy, float(copy > 0.8), float(copy > 0.93), known, shaped, marked, other, float(other > 0.3), float(known < 0.5), float(known < 0.75), float(n < 3),
            short, max(0.0, short - 0.1), max(0.0, short - 0.2), max(0.0, short - 0.3), max(0.0, short - 0.5), max(0.0, short - 0.8), short * long, max(0.0, short - 0.15) * long,
            float(not ends), float(s_ends and not ends), float(s_ends and not ends) * min(short, 0.6), float(cut), float(cut) * min(short, 0.6), 1 - recall, max(0.0, 1 - stops), 1 - fields, (1 - fields) * float(short > 0.15),
            shared, float(shared == 0), known * float(shared == 0), float(max(0.0, ratio) > 0.3), max(0.0, ratio),
        ]
        grams = rest + [f"{a} {b}" for a, b in zip(tokens, tokens[1:]) if not (a in source or b in source)]
        if other > 0.3:  # scripts without spaces
            grams += [x + y for w in rest for x, y in zip(w, w[1:])]
        return [xxhash.xxh32_intdigest(g.encode()) % DIM for g in grams], dense, copy


def _variants(text: str, rng: np.random.Generator) -> str:
    k = rng.integers(8)
    if k == 0:
        return text.upper()
    if k == 1:
        return text.lower()
    if k == 2:
        return f"“{text}”"
    if k == 3:
        return "  ".join(text.split(" ")) + "\n"
    return text


def _truncated(text: str, rng: np.random.Generator) -> str:
    keep = rng.uniform(0.12, 0.76)
    at = max(6, int(len(text) * keep))
    cut = text[:at]
    if rng.random() < 0.6 and " " in cut:
        cut = cut[: cut.rindex(" ")]
    return cut + ["", "", "", "", "...", "…", " [...]", " -", " và", ",", " ("][rng.integers(11)]


#: First letters of blocks of other scripts, and how many letters are taken.
_SCRIPTS = ((0xAC00, 2000), (0x430, 32), (0x3B1, 24), (0xE01, 46), (0x905, 50), (0x627, 28), (0x5D0, 27), (0x10D0, 33), (0x4E00, 3000), (0x3042, 80), (0x561, 38), (0x985, 40), (0x1780, 35), (0x1000, 33))
_MARKS = "\u0300\u0301\u0308\u030a\u030c\u0327\u0328\u0304\u0306\u030b"


def disguised(text: str, names: list[str], rng: np.random.Generator) -> str:
    """A text in a language that does not exist, in Latin or another script; given
    names stay for two texts in three."""
    kept = names if rng.random() < 0.67 else []
    parts = re.split("(" + "|".join(map(re.escape, kept)) + ")", unmarked(text)) if kept else [unmarked(text)]
    table: dict[str, str] = {}
    if rng.random() < 0.5:
        for group in ("aeiouy", "bcdfghjklmnpqrstvwxz"):
            for a, b in zip(group, rng.permutation(list(group)), strict=True):
                if rng.random() < 0.12:
                    b = unicodedata.normalize("NFC", b + _MARKS[rng.integers(len(_MARKS))])
                if rng.random() < 0.1:
                    b += "aeinrstlk"[rng.integers(9)]
                table[a], table[a.upper()] = b, b.upper()
        new = ["".join(table.get(ch, ch) for ch in t) for t in parts]
    else:
        low, many = _SCRIPTS[rng.integers(len(_SCRIPTS))]
        blank = " " if many not in (46, 3000, 80, 35, 33) or low == 0x10D0 else ""
        # A syllable or sign for a few letters where a script has many.
        width = 3 if many >= 1000 else 1
        new = []
        for t in parts:
            words = [w if not w.strip().isalpha() else "".join(chr(low + _number(w[i : i + width].lower()) % many) for i in range(0, len(w), width)) for w in re.findall(r"[A-Za-z]+|[^A-Za-z]+", t)]
            new.append("".join(blank if w.isspace() else w for w in words))
    return "".join(old if k % 2 else n for k, (old, n) in enumerate(zip(parts, new, strict=True)))


def _number(text: str) -> int:
    return xxhash.xxh32_intdigest(text.encode())


def made_pairs(sound: list[tuple[str, str, str]], seed: int) -> list[tuple[str, str, str, str]]:
    """(english, japanese, answer, label) with label '' for sound answers."""
    rng = np.random.default_rng(seed)
    other = {line.partition("|")[0]: line.split("|")[1:] for line in _OTHER.strip().splitlines()}
    out = []
    for en, jp, vi in sound:
        bare = unmarked(vi) if rng.random() < 0.15 else vi
        out += [(en, jp, vi, ""), (en, jp, _variants(vi, rng), "")]
        if rng.random() < 0.3:
            out.append((en, jp, unmarked(vi), ""))
        if rng.random() < 0.5:
            out.append((en, jp, vi.rstrip(_END).rstrip(".!?…。"), ""))
        if len(canon(vi)) >= 12:
            out += [(en, jp, _variants(_truncated(bare, rng), rng), "truncated"), (en, jp, _truncated(bare, rng), "truncated")]
        own = [s for s in (en, jp) if canon(s)]
        out.append((en, jp, _variants(own[rng.integers(len(own))], rng), "copied"))
        names = re.findall(r"\b[A-Z][a-z]+ [A-Z][a-z]+\b", vi) or [""]
        out.append((en, jp, _variants(disguised([en, vi][rng.integers(2)] or vi, [n for n in dict.fromkeys(names) if n], rng), rng), "wrong_language"))
        if rng.random() < 0.25:
            a, b, _ = sound[rng.integers(len(sound))]
            swapped = [s for s in (a, b) if canon(s)]
            swap = swapped[rng.integers(len(swapped))]
        else:
            lines = other[list(other)[rng.integers(len(other))]]
            swap = " ".join(lines[i] for i in rng.permutation(len(lines))[: rng.integers(1, 4)]).replace("{n}", names[0])
        out.append((en, jp, _variants(swap, rng), "wrong_language"))
        parts = _REFUSE[list(_REFUSE)[rng.integers(len(_REFUSE))]]
        said = "".join(p[rng.integers(len(p))] for p in parts)
        said = (["", "", "", "", "Dịch: ", "Bản dịch: ", "Trả lời: "][rng.integers(7)] + said[:1].upper() + said[1:]).strip()
        out.append((en, jp, _variants(unmarked(said) if rng.random() < 0.1 else said, rng), "refusal"))
    return out


class Model:
    def __init__(self, features: Features):
        self.features = features
        self.w = np.zeros((DIM, len(LABELS)))
        self.v = np.zeros((Features.DENSE, len(LABELS)))
        self.thresholds = np.full(len(LABELS), 0.0)
        self.slope, self.shift = np.ones(len(LABELS)), np.zeros(len(LABELS))

    def _rows(self, pairs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashed, dense = [], []
        for en, jp, vi, *_ in pairs:
            h, d, _ = self.features.of(en, jp, vi)
            hashed.append(h or [0])
            dense.append(d)
        return np.concatenate([np.asarray(h) for h in hashed]) if hashed else np.zeros(0, dtype=int), np.array([len(h) for h in hashed]), np.array(dense).reshape(-1, Features.DENSE)

    def scores(self, pairs) -> np.ndarray:
        flat, size, dense = self._rows(pairs)
        return self._scores(flat, size, dense)

    def _scores(self, flat: np.ndarray, size: np.ndarray, dense: np.ndarray) -> np.ndarray:
        if not len(size):
            return np.zeros((0, len(LABELS)))
        sums = np.add.reduceat(self.w[flat], np.r_[0, np.cumsum(size)[:-1]], axis=0)
        return sums / np.sqrt(size)[:, None] + dense @ self.v

    def fit(self, pairs: list[tuple[str, str, str, str]], seed: int = 3) -> None:
        """Logistic loss, mini-batches, Adam.  A refusal or copy in another
        language says nothing about wrong_language and truncated."""
        flat, size, dense = self._rows(pairs)
        ends = np.cumsum(size)
        labels = np.array([p[3] for p in pairs])
        y = np.stack([labels == k for k in LABELS], axis=1).astype(float)
        care = np.ones_like(y)
        care[np.isin(labels, ["refusal", "copied"]), LABELS.index("wrong_language")] = 0
        care[np.isin(labels, ["refusal", "copied", "wrong_language"]), LABELS.index("truncated")] = 0
        care *= np.where(y > 0, 1.0, np.minimum(1.0, 4 * y.sum(0) / np.maximum(1, (1 - y).sum(0))))
        rng = np.random.default_rng(seed)
        state = [np.zeros_like(x) for x in (self.w, self.w, self.v, self.v)]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(pairs))
            for k in range(0, len(order), BATCH):
                rows = order[k : k + BATCH]
                idx = np.concatenate([flat[ends[r] - size[r] : ends[r]] for r in rows])
                # Half of the pairs go without their n-grams, so the pair features
                # alone must tell defects whose words were never seen; but a refusal
                # is told by its words.
                seen = ((rng.random(len(rows)) < 0.5) | (labels[rows] == "refusal"))[:, None]
                sums = np.add.reduceat(self.w[idx], np.r_[0, np.cumsum(size[rows])[:-1]], axis=0)
                s = seen * sums / np.sqrt(size[rows])[:, None] + dense[rows] @ self.v
                g = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y[rows]) * care[rows] / len(rows)
                each = np.repeat(seen * g / np.sqrt(size[rows])[:, None], size[rows], axis=0)
                gw = np.stack([np.bincount(idx, weights=each[:, j], minlength=DIM) for j in range(len(LABELS))], axis=1) + 1e-6 * self.w
                gv = dense[rows].T @ g + 1e-5 * self.v
                step += 1
                for x, grad, m, s2, rate in ((self.w, gw, state[0], state[1], 0.02), (self.v, gv, state[2], state[3], 0.05)):
                    m += 0.1 * (grad - m)
                    s2 += 0.01 * (grad * grad - s2)
                    x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s2 / (1 - 0.99**step)) + 1e-8)

    def calibrate(self, pairs: list[tuple[str, str, str, str]], sound_share: float = 0.999) -> None:
        """Per label a threshold in the gap between held-out sound answers or
        lower kinds and held-out defects, nearer to the former, because real
        defects differ from made ones more than real sound answers do; where the
        two overlap, the threshold of the best F1, sound answers weighing ten times.
        ``sound_share`` of the sound answers are taken to be sound indeed."""
        s = self.scores(pairs)
        labels = np.array([p[3] for p in pairs])
        for j, kind in enumerate(LABELS):
            use = (labels == "") | (labels == kind) | np.isin(labels, KINDS[KINDS.index(kind) + 1 :])
            x, t = s[use, j], labels[use] == kind
            self.slope[j], self.shift[j] = _platt(s[use, j], labels[use] == kind)
            others = {k: x[labels[use] == k] for k in set(labels[use]) - {kind}}
            low = max((np.quantile(v, sound_share if k == "" else min(sound_share, 0.99)) for k, v in others.items() if len(v)), default=0.0)
            high = np.quantile(x[t], 0.01)
            if high > low:
                self.thresholds[j] = low + GAP * (high - low)
                continue
            weight = np.where(labels[use] == "", 10.0, 1.0)
            order = np.argsort(-x)
            tp, fp = np.cumsum(t[order]), np.cumsum(np.where(t[order], 0, weight[order]))
            i = int(np.argmax(2 * tp / (tp + fp + t.sum())))
            self.thresholds[j] = (x[order][i] + x[order][min(i + 1, len(x) - 1)]) / 2

    def kinds(self, pairs: list[tuple[str, str, str]]) -> list[str | None]:
        s = self.scores(pairs)
        over = (s > self.thresholds) & (s * self.slope + self.shift > 0)
        return ["empty" if is_empty(p[2]) else (LABELS[int(np.argmax(o))] if o.any() else None) for p, o in zip(pairs, over, strict=True)]


def _platt(score: np.ndarray, true: np.ndarray, rounds: int = 30) -> tuple[float, float]:
    """Slope and shift that turn scores into log-odds, by Newton steps with a weak
    pull, so that separated classes give finite ones."""
    x, y, w = np.stack([score, np.ones(len(score))], axis=1), true.astype(float), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 0.1 * (w - [1.0, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        w = w - np.clip(np.linalg.solve(h, g), -1, 1)
    return max(float(w[0]), 1e-3), float(w[1])


class Exact:
    """What remains without training data."""

    def kinds(self, pairs):
        return ["empty" if is_empty(v) else "copied" if canon(v) in (canon(e), canon(j)) else None for e, j, v in pairs]


def train(sound: list[tuple[str, str, str]]) -> Model | Exact:
    sound = [p for p in sound if not is_empty(p[2]) and (canon(p[0]) or canon(p[1]))]
    if len(sound) < LEAST:
        return Exact()
    # Answers that share few words with the others are left out first, or the model
    # would learn the few answers of each other language as sound ones.
    f = Features(sound)
    share = np.array([f.of(*p)[1][Features.SHARE] for p in sound])
    sound = [p for p, s in zip(sound, share, strict=True) if s >= 0.6 * np.median(share)]
    if len(sound) < LEAST:
        return Exact()
    model = None
    # The first, smaller model only cleans the sample of its real defects.
    for size, share in ((len(sound) // 4, 0.96), (len(sound), 0.999)):
        part = sound[: max(size, LEAST)]
        f = Features(part)
        cut = max(len(part) * 4 // 5, 1)
        model = Model(f)
        model.fit(made_pairs(part[:cut], 1))
        model.calibrate(made_pairs(part[cut:], 2), share)
        sound = [p for p, k in zip(sound, model.kinds(sound), strict=True) if k is None]
        if len(sound) < LEAST:
            break
    return model


def defects(log: DataFrame, lines: DataFrame, seq: str, answer: str, keys: list[str], first: str, second: str, sample: int = SAMPLE) -> DataFrame:
    """(seq, defect) for every pair of a log row and the line with the same keys.

    ``lines`` may hold a line several times with equal content; one is used.
    ``sample`` bounds the training data.
    """
    spark = log.sparkSession
    ship(spark)
    one = lines.select(*keys, F.col(first).alias("__a"), F.col(second).alias("__b")).dropDuplicates(keys)
    told = log.select(F.col(seq).alias("__seq"), *keys, F.col(answer).alias("__v"))
    # The lowest hashes; the bound lets only a few times the sample be looked up.
    h = F.pmod(F.xxhash64("__seq"), F.lit(1 << 40))
    bound = int((1 << 40) * min(1.0, 4 * sample / max(log.count(), 1)))
    few = told.filter((F.length("__v") > 8) & (h < bound)).orderBy(h, "__seq").limit(3 * sample)
    rows = lines.select(*keys, F.col(first).alias("__a"), F.col(second).alias("__b")).join(F.broadcast(few), keys).dropDuplicates(["__seq"])
    rows = rows.orderBy(h, "__seq").limit(sample).select("__a", "__b", "__v").collect()
    pairs = many_to_one(told, one, keys).select("__seq", "__a", "__b", "__v")
    model = spark.sparkContext.broadcast(train([(plain(a), plain(b), plain(v)) for a, b, v in rows]))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            kinds = model.value.kinds([(plain(a), plain(b), plain(v)) for a, b, v in zip(f["__a"], f["__b"], f["__v"], strict=True)])
            out = pd.DataFrame({seq: f["__seq"], "defect": pd.Series(kinds, index=f.index, dtype=object)})
            yield out[out["defect"].notna()]

    kind = log.schema[seq].dataType.simpleString()
    return pairs.mapInPandas(score, f"`{seq}` {kind}, defect string")
