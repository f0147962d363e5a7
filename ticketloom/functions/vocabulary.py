"""Word lists behind language detection and the built-in glossary translation."""

from __future__ import annotations

# Frequent function words per language, lower case. Ties go to the language
# listed first: English, which is left as it is.
STOP_WORDS = {
    "English": (
        "a and are as at be by for from had has have he his i in is it not of on or she "
        "that the their they this to was were which with you"
    ).split(),
    "Dutch": (
        "aan als bij dat de die dit een en er geen had heb heeft het hoe ik in is je kan "
        "maar me met mijn naar niet nog of om ook op te tot uit van voor was wat we wij "
        "worden zijn"
    ).split(),
    "French": (
        "au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous "
        "on ou par pas pour que qui sa se son sur un une vous"
    ).split(),
    "German": (
        "als am auch auf aus bei das dem den der des die ein eine er es für ich ihr im in "
        "ist mit nicht noch nur oder sich sie sind und von war wie wir zu zum zur"
    ).split(),
    "Spanish": (
        "al como con de del el ella en es esta este ha la las lo los más no para pero por "
        "que se sin sobre su sus un una y ya"
    ).split(),
}

# Word-for-word glossaries into English, lower case.
DUTCH_TO_ENGLISH = {
    "aan": "to",
    "alarm": "alarm",
    "beste": "dear",
    "bij": "at",
    "dag": "day",
    "dank": "thanks",
    "dat": "that",
    "de": "the",
    "deze": "this",
    "een": "a",
    "en": "and",
    "geen": "no",
    "goed": "good",
    "groet": "regards",
    "hallo": "hello",
    "heb": "have",
    "heeft": "has",
    "help": "help",
    "het": "the",
    "hoe": "how",
    "ik": "I",
    "in": "in",
    "is": "is",
    "kan": "can",
    "klant": "customer",
    "mail": "mail",
    "met": "with",
    "mijn": "my",
    "naar": "to",
    "niet": "not",
    "nieuw": "new",
    "nog": "still",
    "of": "or",
    "op": "on",
    "probleem": "problem",
    "van": "of",
    "voor": "for",
    "vraag": "question",
    "werkt": "works",
    "wij": "we",
    "zijn": "are",
}
GERMAN_TO_ENGLISH = {
    "auch": "also",
    "auf": "on",
    "das": "the",
    "dem": "the",
    "den": "the",
    "der": "the",
    "des": "of the",
    "die": "the",
    "ein": "a",
    "eine": "a",
    "er": "he",
    "es": "it",
    "für": "for",
    "ich": "I",
    "im": "in the",
    "in": "in",
    "ist": "is",
    "mit": "with",
    "nicht": "not",
    "sich": "itself",
    "sie": "she",
    "sind": "are",
    "und": "and",
    "von": "of",
    "war": "was",
    "zu": "to",
}
GLOSSARIES = {"Dutch": DUTCH_TO_ENGLISH, "German": GERMAN_TO_ENGLISH}
