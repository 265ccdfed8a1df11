"""Defective question-answer pairs (problem 1).

Each answer is read once, in this order; the first that holds is its defect:

* ``empty_answer``: null, or without a letter or digit;
* ``refusal``: a sentence derives from a grammar of refusals (productions below): openers ("Sorry, ", "As an assistant "), then somebody who
  answers and can't or won't, or the request that can't be met. Quoted passages are left out first; a reported refusal ("The letter says that
  ... cannot") has another subject, and what a page says of its writers ("We do not ship on Sundays") has another verb, so neither counts;
* ``copies_question``: greedy string tiling of the answer with pieces of the question covers it, but for a lead-in;
* ``other_language``: script, then function words, of answer and question differ; quoted passages are left out, a bare value has no language;
* ``truncated_answer``: a pushdown parser of fences, brackets, quotation marks, list markers and markup ends with something open, or
  the text breaks off without an end. A summary of exactly ``summary_words`` words closed by ``...`` is whole if the reasoning type is
  comprehension or unknown; a bare value or name is whole.

Defined results for odd input: null, blank or very long answers are ordinary cases (a null question copies nothing and has no language);
every delivered row is judged by itself, so repeated rows give repeated verdicts under their own id; an empty table gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.batches import map_columns
from leafgraph.llm.words import WORD, language_of

DEFECTS = ("empty_answer", "truncated_answer", "refusal", "copies_question", "other_language")

_INK = re.compile(r"[^\W_]")
_QUOTED = re.compile(r'"[^"]*"|“[^”]*”|«[^»]*»|„[^“”]*[“”]')

# --- refusals -----------------------------------------------------------------------------------------------------------------------
# The grammar of refusals, over lower-case text with plain apostrophes. ``<name>`` stands for another production.
GRAMMAR = {
    "refusal": "<openers>(?:<person> <unable>|<person>(?:'m|'ve| am| are| have| do| did)? ?<lacking>|<no answer>|<impossible>|<request> <unmet>|<answering> <outside>|<beyond>|<french>|<german>|<spanish>)",
    "openers": "(?:(?:<regret>|<role>)[,;:.! ]+(?:(?:but|that|to say that|mais|aber|pero) )?)*",
    "regret": (
        "(?:well|so|sorry|very sorry|apologies|my apologies|unfortunately|regrettably|regretfully|sadly|please note that|however|but|and|i am sorry|i'm sorry|i'm so sorry|i am afraid|i'm afraid"
        "|i apologi[sz]e|i regret|we are sorry|we regret|désolée?|je suis désolée?|malheureusement|leider|es tut mir leid|entschuldigung|lo siento|lamentablemente|perdón)"
    ),
    "role": r"(?:(?:as|being) an? (?:\w+ ){0,3}?(?:assistant|model|system|program|ai|bot))",
    "person": "(?:i|we)",
    "unable": (
        "(?:(?:really |simply |just )?(?:can't|cannot|can not|could not|couldn't|couldnt|cant|won't|wont|will not|would rather not|would prefer not|prefer not|am unable|are unable|was unable|were unable|was not able|wasn't able"
        "|were not able|must decline|decline|must refuse|refuse|have to decline|may not|must not|see no way|know of no|lack|haven't|have not been|have no)\\b)"
    ),
    "lacking": "(?:unable\\b|not (?:really |quite |at all )?<not able>|(?:n't|not) (?:really |actually )?<not know>|n't <not able>|no (?:answer|information|knowledge|way|access|idea|basis|data|means)\\b|do(?:n't|nt| not) <not know>|did(?:n't| not) <not know>|am not <not able>|are not <not able>|not been able)",
    "not able": "(?:able|allowed|permitted|authori[sz]ed|in a position|sure|certain|going to|willing|at liberty|comfortable|qualified|aware|prepared|equipped|capable|inclined|free to|supposed)\\b",
    "not know": "(?:know|have|see|find|think|feel|want|wish|recall|understand|believe|provide|give|answer|share|disclose|comment|say|tell|discuss|possess|care|intend|recogni[sz]e|hold|offer|consider|dare)\\b",
    "no answer": r"no (?:answer|reply|response|information)\b[^.]* by (?:me|us)\b",
    "impossible": r"it(?: is not|'s not| isn't| is impossible|'s impossible| was not| wasn't)\b[^.]*\bfor (?:me|us)\b",
    "request": "(?:that|this|your|such a) (?:request|question|query|inquiry)",
    "unmet": "(?:cannot|can't|can not|could not|couldn't|won't|will not) be (?:answered|fulfilled|completed|processed|met|handled|addressed|granted|resolved)\\b",
    "answering": "(?:answering|replying|responding|an answer|a reply|a response)(?: to)?(?: (?:that|this|the|your|it))?(?: (?:question|request|query))?(?: here)?",
    "outside": r"(?:is (?:impossible|not possible|out of the question)|isn't possible|(?:falls|lies|goes|is) (?:outside|beyond)|exceeds) ?[^.]*",
    "beyond": r"(?:this|that|it) (?:is|goes|lies|falls) (?:beyond|outside) (?:my|what i|our|what we|what this assistant)\b",
    "french": "(?:je ne (?:peux|puis|sais|suis)|je n'ai (?:pas|aucune?))",
    "german": r"(?:ich kann\b[^.]*\b(?:nicht|keine?)|ich (?:weiß|habe)\b[^.]*\b(?:nicht|keine?))",
    "spanish": r"(?:(?:yo )?no (?:puedo|sé|tengo)\b)",
}


def _derived(name: str) -> str:
    """The pattern of a production; the grammar has no recursion, so its language is regular."""
    return re.sub(r"<([a-z ]+)>", lambda m: _derived(m[1]), GRAMMAR[name])


_REFUSAL = re.compile(rf"(?:^|[.!?\n]\s*){_derived('refusal')}")
_ONLY_SORRY = re.compile(r"\W*(?:(?:i'm|i am|we are|we're) (?:very |so )?sorry|sorry|my apologies|apologies)\W*")
#: Letters without which no sentence of the grammar can be derived; most answers are done with after this.
_MAY_REFUSE = re.compile(r"\b(?:i|i'm|we|me|us|my|our|sorry|je|ich|no|yo|apologies|request|question|query|inquiry|answering|replying|responding|answer|reply|response)\b")


def refuses(answer: str) -> bool:
    low = answer.lower().replace("’", "'")
    if not _MAY_REFUSE.search(low):
        return False
    low = " ".join(_QUOTED.sub(" ", low).split())
    return bool(_REFUSAL.search(low) or _ONLY_SORRY.fullmatch(low))


# --- copies -------------------------------------------------------------------------------------------------------------------------
# Words of a lead-in before a repeated question.
_LEAD = frozenset("a about again an and answer are as asked asking asks been following for have here i is it me my of please q question quote reads regarding repeat repeated so that the this to was well what you your".split())
_COVER = 0.8


def tiles(answer: list[str], question: list[str], least: int) -> tuple[list[bool], list[bool]]:
    """Greedy string tiling: tokens of the answer and of the question that lie in common pieces of ``least`` tokens or more.

    Longest pieces first; a piece of the question may be used again, as a question may be repeated twice."""
    n = len(answer)
    at: dict[str, list[int]] = {}
    for j, w in enumerate(question):
        at.setdefault(w, []).append(j)
    longest = []
    for i in range(n):
        best, where = 0, 0
        for j in at.get(answer[i], ()):
            k = 1
            while i + k < n and j + k < len(question) and answer[i + k] == question[j + k]:
                k += 1
            if k > best:
                best, where = k, j
        if best >= least:
            longest.append((-best, i, where))
    in_answer, in_question = [False] * n, [False] * len(question)
    for size, i, j in sorted(longest):
        if not any(in_answer[i : i - size]):
            in_answer[i : i - size] = [True] * -size
            in_question[j : j - size] = [True] * -size
    return in_answer, in_question


def copies(answer: str, question: str | None) -> bool:
    if not question:
        return False
    a, q = WORD.findall(answer.lower()), _question_words(question)
    known = frozenset(q)
    if len(q) < 2 or len(a) < 0.6 * len(q) or sum(w in known for w in a) < 0.5 * len(a):
        return False
    in_answer, in_question = tiles(a, q, min(3, len(q)))
    rest = [w for w, inside in zip(a, in_answer) if not inside]
    covered = sum(in_question) / len(q)
    if covered >= _COVER and all(w in _LEAD or w in known for w in rest):
        return True
    first = in_answer.index(True) if True in in_answer else len(a)
    if covered >= _COVER and len(rest) == first <= 8 and re.match(r"[^:]{1,80}:", answer.strip()):
        return True
    return not set(a) - known and sum(in_answer) >= 0.6 * len(a) and len(a) >= 5


@lru_cache(4096)
def _question_words(question: str) -> list[str]:
    return WORD.findall(question.lower())


# --- languages ----------------------------------------------------------------------------------------------------------------------
@lru_cache(4096)
def _question_language(question: str) -> str:
    return language_of(_QUOTED.sub(" ", question))


def answers_in_other_language(answer: str, question: str | None) -> bool:
    if not question:
        return False
    mine = language_of(_QUOTED.sub(" ", answer))
    return bool(mine) and bool(theirs := _question_language(question)) and mine != theirs


# --- truncation ---------------------------------------------------------------------------------------------------------------------
_OPEN = {"(": ")", "[": "]", "{": "}", "“": "”", "«": "»", "„": "“"}
_CLOSE = frozenset(_OPEN.values())
_LIST = re.compile(r"(?:^|\n)[ \t]*(?:[-*•]|\d{1,3}[.)]|[a-z][.)])[ \t]*\Z")
_MARKUP = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)(?:\s[^<>]*)?(/?)>|<(/?[a-zA-Z][^<>]*)\Z")
_VOID = frozenset("br hr img input meta link".split())
# Words that a whole sentence or value doesn't end with.
_DANGLING = frozenset("a about after although an and as at because before behind between but by during each every for from if in instead into is its nor of on or our provided since than that the their this through throughout to under unless until upon was were when whereas which while with within without your le la les des du de un une et ou avec pour dans der die das den dem ein eine und oder mit von el los las y con para del".split())
_NEVER_LAST = frozenset("a an the and or but because whereas although unless each every our their my your his its le la les un une der die das el los las und et y".split())
_SUBJECT = frozenset("the each every our their this that these those my your his her its a an".split())
_SENTENCE_WORDS = frozenset("a an the each every our their this that these those which because whereas although while when by of to with from in at under".split())
_END = re.compile(r"""[.!?。！？][)\]}"'”’»*_`]*\Z""")


_CONNECTORS = frozenset("a an the of and or for in to on at by with de la le des du von der und y".split())


def is_name(words: list[str]) -> bool:
    """Whether words read as a title or name: an article, then capitals, with connectors between them."""
    content = [w for w in words if w.lower().strip("\"'“”‘’(),.") not in _CONNECTORS]
    return len(content) >= 2 and all(w.lstrip("\"'“‘(")[:1].isupper() for w in content)


def open_at_end(text: str) -> bool:
    """Whether fences, brackets, quotation marks, emphasis or tags are still open where the text ends, or a list marker stands alone."""
    if not any(c in text for c in '([{"“«„`<*-•') and not _LIST.search(text):
        return False
    if text.count("```") % 2:
        return True
    stack: list[str] = []
    for m in _MARKUP.finditer(text):
        if m[4] is not None:
            return True
        if m[3] or m[2].lower() in _VOID:
            continue
        if not m[1]:
            stack.append(m[2].lower())
        elif m[2].lower() in stack:
            del stack[len(stack) - 1 - stack[::-1].index(m[2].lower()) :]
    if stack:
        return True
    for i, ch in enumerate(text):
        if ch == '"':
            if stack and stack[-1] == '"':
                stack.pop()
            elif '"' in stack:  # a bracket left open inside a quotation that closes
                return True
            elif not (i and text[i - 1].isdigit() and text.count('"') == 1):  # 12" is a measure
                stack.append('"')
        elif stack and ch == stack[-1]:
            stack.pop()
        elif ch in _OPEN and not (ch in "([{" and i and text[i - 1] in ":;"):
            stack.append(_OPEN[ch])
    if stack:
        return True
    if text.count("**") % 2 or text.count("`") % 2:
        return True
    return bool(_LIST.search(text)) and bool(_INK.search(text))


def breaks_off(answer: str, reasoning_type: str | None, summary_words: int = 30) -> bool:
    text = answer.strip()
    words = text.split()
    if text.endswith("...") and len(words) == summary_words and (reasoning_type or "comprehension").strip().lower() == "comprehension":
        return False
    if text.endswith(("...", "…")):
        return True
    if len(words) > 1 and open_at_end(text):
        return True
    last = WORD.findall(words[-1].lower())
    if _END.search(text):
        return len(words) > 2 and bool(last) and last[-1] in _NEVER_LAST and words[-1].islower()
    if len(words) < 2:
        return text[-1] in ",;:-‐\xad" and len(text) > 1
    if text[-1] in ",;:(/&-‐\xad¬":
        return True
    if last and last[-1] in _DANGLING and words[-1].islower() and len(words) > 2:
        return True
    bare = [w for w in WORD.findall(text.lower())]
    if is_name(words):
        return False
    if bare and bare[0] in _SUBJECT and words[0].lower() == bare[0] and len(words) >= 4:
        return True
    if re.search(r"[a-z]{2}[.!?]\s+[A-Z]", text) and len(words) >= 5:
        return True
    return len(words) >= 7 and sum(w in _SENTENCE_WORDS for w in bare) >= 2


# --- operator -----------------------------------------------------------------------------------------------------------------------
def defect_of(question: str | None, answer: str | None, reasoning_type: str | None, summary_words: int = 30) -> str | None:
    """The one defect of a pair, or None if it has none."""
    if answer is None or not _INK.search(answer):
        return "empty_answer"
    if refuses(answer):
        return "refusal"
    if copies(answer, question):
        return "copies_question"
    if len(answer) > 12 and answers_in_other_language(answer, question):
        return "other_language"
    if breaks_off(answer, reasoning_type, summary_words):
        return "truncated_answer"
    return None


def defective_pairs(df: DataFrame, row_id: str = "row_no", question: str = "question", answer: str = "answer", reasoning_type: str = "reasoning_type", summary_words: int = 30) -> DataFrame:
    """Rows (row_no, defect_type) of the pairs with a defect. One narrow pass: no shuffle, nothing collected."""

    def make():
        def run(ids, qs, ans, kinds):
            hits = [(i, d) for i, q, a, k in zip(ids, qs, ans, kinds) if (d := defect_of(q, a, k, summary_words))]
            return {"row_no": [h[0] for h in hits], "defect_type": [h[1] for h in hits]}

        return run

    columns = {"i": F.col(row_id).cast("long"), "q": question, "a": answer, "k": reasoning_type}
    return map_columns(df, columns, make, "row_no long, defect_type string")


def defect_counts(df: DataFrame, **columns: str) -> DataFrame:
    """Pairs by kind of defect."""
    return defective_pairs(df, **columns).groupBy("defect_type").agg(F.count("*").alias("pairs"))
