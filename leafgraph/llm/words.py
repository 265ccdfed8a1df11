"""Words, function words and languages, shared by the text operators."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\W_]+")

# Function words by language.
FUNCTION_WORDS = {
    "en": "a about after again all an and any are as at be because been before behind between but by can could did do does during each either every for from had has have he her his how if in instead into is it its my no nor not of on one or our out over she should since so some than that the their them then there these they this those through throughout to under unless until upon was we were what when where whereas which while who why will with within without would yes you your".split(),
    "fr": "au aucun aucune aux avant avec c ce ces cet cette chaque combien comme d dans de depuis des dont du elle elles en entre est et il ils je l la le les leur leurs lieu mais ne ni nos notre nous on ont ou où par pas pour pourquoi près qu quand que quel quelle qui s sans se selon ses son sont sous sur un une vers vos votre vous à été après".split(),
    "de": "aber als am an auch auf aus bei bis das dem den der des die diese diesem diesen dieser dieses durch ein eine einem einen einer eines er es für gegen hat haben ich ihr ihre im in ist jede jedem jeden jeder jedes kein keine man mit nach nicht ob oder ohne seine seit sich sie sind statt und unser unsere unter vom von vor wann war was wer werden wie wir wird wo wurde zu zum zur über".split(),
    "es": "al antes cada como con contra cuál cuándo cuánto de del desde después donde dónde el ella en entre es esta este estos está fue ha hasta la las lo los más ni ninguna ninguno no nuestra nuestro o para pero por porque que quién qué se según sin sobre son su sus también un una uno y ya él".split(),
}

_LANGUAGES = tuple(FUNCTION_WORDS)
_OF_WORD: dict[str, tuple[int, ...]] = {}
for _i, _l in enumerate(_LANGUAGES):
    for _w in FUNCTION_WORDS[_l]:
        _OF_WORD[_w] = (*_OF_WORD.get(_w, ()), _i)

# Function words of further languages; texts in one of them are told from those above only.
FURTHER_WORDS = {
    "it": "che di del della delle dei degli il lo gli le la un una uno non per con da dal dalla nel nella sono è era ha hanno si ma come più anche questo questa quale quando dove perché suo sua al alla ai".split(),
    "nl": "de het een van en in op te dat die voor met aan niet zijn was wordt werd heeft bij ook naar uit door over maar om als dan deze dit welke wat waar hij zij ze wij hun onze geen nog".split(),
    "pt": "o os as um uma de do da dos das em no na nos nas que não por para com foi são é está mais mas ao à como quando onde qual seu sua pelo pela este esta ele ela eles foram".split(),
    "sv": "och i att det som en på är av för med till den har de inte om ett men var från vid kan sig så eller när hur vad efter under detta denna hans deras vi ska".split(),
    "da": "og i at det som en på er af for med til den har de ikke om et men var fra ved kan sig så eller når hvordan hvad efter under dette denne hans deres vi skal".split(),
    "pl": "i w na z do nie się że jest to o jak po co za od przez dla są był była oraz ale tak przy jego jej ich tym tego który która które czy już".split(),
}
_OF_FURTHER = {w: tuple(k for k, ws in FURTHER_WORDS.items() if w in ws) for ws in FURTHER_WORDS.values() for w in ws}

# Letters that only some of the languages write.
_MARKED = {"ä": "de", "ö": "de", "ü": "de", "ß": "de", "ñ": "es", "¿": "es", "¡": "es", "ç": "fr", "œ": "fr", "è": "fr", "ê": "fr", "û": "fr", "à": "fr"}
_MARK = re.compile("[" + "".join(_MARKED) + "]")

# Code point ranges of scripts.
_SCRIPTS = (("cyrillic", 0x400, 0x52F), ("greek", 0x370, 0x3FF), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF), ("indic", 0x900, 0xDFF), ("thai", 0xE00, 0xE7F), ("kana", 0x3040, 0x30FF), ("han", 0x4E00, 0x9FFF), ("hangul", 0xAC00, 0xD7AF))


def script_of(text: str) -> str:
    """The script of most letters; latin if there are none."""
    if text.isascii():
        return "latin"
    counts: dict[str, int] = {}
    for ch in text:
        if ch.isalpha():
            p = ord(ch)
            name = "latin" if p < 0x370 else next((s for s, lo, hi in _SCRIPTS if lo <= p <= hi), "latin")
            counts[name] = counts.get(name, 0) + 1
    return max(counts, key=counts.get) if counts else "latin"


def language_scores(words: list[str]) -> list[int]:
    """Function words of each language among the lower-case words."""
    scores = [0] * len(_LANGUAGES)
    get = _OF_WORD.get
    for w in words:
        for i in get(w, ()):
            scores[i] += 1
    return scores


def language_of(text: str, least: int = 2) -> str:
    """Language (or script) that the text is written in; empty if there is too little to tell."""
    script = script_of(text)
    if script != "latin":
        return script
    low = text.lower()
    words = WORD.findall(low)
    scores = language_scores(words)
    if not low.isascii():
        for ch in _MARK.findall(low):
            scores[_LANGUAGES.index(_MARKED[ch])] += 1
    best = max(scores)
    if best >= least and best * 6 >= len(words) and scores.count(best) == 1 and best * 3 >= len(words):
        return _LANGUAGES[scores.index(best)]
    further = _further_language(words, best)
    if further:
        return further
    if best < least or best * 6 < len(words) or scores.count(best) > 1:
        return ""
    return _LANGUAGES[scores.index(best)]


def _further_language(words: list[str], best: int) -> str:
    """A further language that has more of the words, three at least and a fourth of all, than any of the main ones (``best``)."""
    if len(words) < 4:
        return ""
    counts: dict[str, int] = {}
    for w in words:
        for k in _OF_FURTHER.get(w, ()):
            counts[k] = counts.get(k, 0) + 1
    if not counts:
        return ""
    top = max(counts.values())
    if top < 3 or top * 4 < len(words) or top <= best + 1:
        return ""
    leaders = [k for k, v in counts.items() if v == top]
    return leaders[0] if len(leaders) == 1 else "-".join(sorted(leaders))  # close kin, such as Danish and Swedish: none of the main ones anyway
