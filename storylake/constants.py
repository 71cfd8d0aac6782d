"""Fixed values shared by several operators."""

# Price in USD per one million tokens (input, output) by model name.
MODEL_PRICES = {
    "openai/gpt-oss-20b": (0.075, 0.30),
    "openai/gpt-oss-120b": (0.15, 0.60),
    "qwen/qwen3.6-27b": (0.60, 3.00),
}
DEFAULT_MODEL = "openai/gpt-oss-20b"

# Column order of the tagged-summaries export, with the type of each column.
TAGGED_SUMMARY_COLUMNS = [
    ("story_id", "string"),
    ("title", "string"),
    ("url", "string"),
    ("publish_date", "date"),
    ("media_name", "string"),
    ("language", "string"),
    ("about_score", "double"),
    ("about_is_about", "boolean"),
    ("about_reason", "string"),
    ("about_error", "string"),
    ("llm_summary_text", "string"),
    ("llm_summary_is_confident", "boolean"),
    ("llm_summary_error", "string"),
    ("zero-shot-tags", "string"),
    ("zero-shot-tag-scores", "string"),
    ("zeroshot_error", "string"),
]

# Story metadata kept in the label export.
LABEL_EXPORT_COLUMNS = ["story_id", "title", "url", "publish_date", "media_name", "language"]

# Defaults of label scoring.
DEFAULT_LABELS = ("politics", "economy", "environment", "technology", "health")
DEFAULT_HYPOTHESIS_TEMPLATE = "This text is about {}"
UNKNOWN_LABEL = "unknown"

# Number of equal score bins between 0 and 1.
SCORE_BINS = 10

# Function words left out of keyword, label and summary scoring, by language code.
STOPWORDS = {
    "en": (
        "a about after all also an and are as at be been but by can could for from had has "
        "have he her his if in into is it its more no not of on one or our out she so than "
        "that the their them there they this to up was we were what when which who will "
        "with would you"
    ).split(),
    "fr": (
        "à au aux avec ce ces dans de des du elle en est et eux il ils je la le les leur "
        "lui mais me même mes moi mon ne nos notre nous on ou par pas pour qu que qui sa se "
        "ses son sur ta te tes toi ton tu un une vos votre vous"
    ).split(),
    "de": (
        "aber als am an auch auf aus bei bin bis da das dass dem den der des die dies du ein "
        "eine einem einen einer er es für hat ich ihr im in ist ja mit nach nicht noch nur "
        "oder sein sich sie sind so um und uns von vor war was wie wir zu zum zur über"
    ).split(),
    "es": (
        "a al como con de del desde donde el ella en entre era es esa ese esta este ha hay "
        "la las le les lo los más me mi muy ni no nos o para pero por que se ser si sin "
        "sobre son su sus también te un una y ya yo"
    ).split(),
}

# Default polarity words for sentence sentiment.
POSITIVE_WORDS = (
    "good great best better win wins won success successful strong gain gains improve "
    "improved growth hope hopeful support supports praised praise welcome benefit benefits "
    "progress happy safe peace positive popular"
).split()
NEGATIVE_WORDS = (
    "bad worst worse lose loses lost fail failed failure weak loss losses decline fear crisis "
    "attack attacks attacked blamed blame criticised criticized threat harm damage dead "
    "killed war negative corrupt scandal unpopular"
).split()

# Abbreviations and words that decide whether a full stop ends a sentence.
#: Titles stand before a name: their stop never ends a sentence.
TITLES = {
    "en": "Mr Mrs Ms Dr Prof Rev Hon Gov Sen Rep Gen Col Maj Capt Cmdr Lt Sgt St Mt".split(),
    "fr": "Mme Mlle MM Me Mgr Ste".split(),
    "de": "Hr Dipl Ing".split(),
    "es": "Sra Srta Dra Lic Gral".split(),
}
#: These stand anywhere: their stop ends a sentence only before a word that opens one.
ABBREVIATIONS = {
    "en": (
        "Jr Sr Inc Ltd Corp Co Bros Jan Feb Aug Sept Oct Nov Dec etc vs approx dept est"
    ).split(),
    "fr": "janv févr juil env".split(),
    "de": "bzw usw ca vgl Nr Str".split(),
    "es": "Ud Uds núm pág aprox".split(),
}
SENTENCE_OPENERS = (
    "The This That These Those He She It We They You But And However When While After Before "
    "Then There If As In On At For Il Elle Ils Elles Der Das Die Es Sie"
).split()
#: Stops of scripts that set no space behind them, and what may close a quotation after them.
UNSPACED_STOPS = "。！？।॥"
CLOSERS = "」』”’）"
