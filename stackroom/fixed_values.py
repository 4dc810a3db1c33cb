"""Word lists, labels, limits and formats that define the results."""

TOPIC_TERMS = {
    "parliament_and_politics": ("parliament", "minister", "government", "election", "mp ", "political party"),
    "te_tiriti_and_maori_affairs": ("te tiriti", "waitangi", "iwi", "hapu", "hapū", "marae", "maori", "māori"),
    "health": ("health", "hospital", "patient", "doctor", "nurse", "covid"),
    "housing": ("housing", "rent", "tenant", "homeless", "mortgage"),
    "justice_and_law": ("court", "judge", "law", "police", "justice", "sentence"),
    "environment_and_climate": ("climate", "environment", "emissions", "conservation", "flood", "drought"),
    "foreign_affairs_and_pacific": (
        "pacific", "foreign affairs", "diplomat", "samoa", "tonga", "fiji", "vanuatu",
    ),
}
SECTION_TERMS = {
    "headlines": ("headlines", "coming up", "in the news"),
    "weather": ("weather forecast", "the forecast", "degrees", "showers"),
    "interview": ("joining us", "my guest", "welcome to the programme"),
    "credits": ("produced by", "executive producer", "you have been listening"),
}
SENSITIVE_TERMS = {
    "children_or_minors": (" child ", " children ", " minor ", " school student "),
    "callers_or_public_contributors": (" caller ", " call us ", " text us ", " talkback "),
    "victims_or_survivors": (" victim ", " survivor ", " bereaved "),
    "distressing_subject_matter": (" suicide ", " sexual assault ", " family violence ", " graphic content "),
}
MAORI_TERMS = ("te", "ngā", "nga", "iwi", "hapū", "hapu", "marae", "whānau", "whanau", "māori", "maori")
PACIFIC_TERMS = ("talofa", "fa'afetai", "mālō", "malo", "bula", "kia orana", "fakaalofa")

MAORI_SIGNAL = "possible_te_reo_maori_or_names"
PACIFIC_SIGNAL = "possible_pacific_language"

CORRECTIONS_VERSION = "operator-curated-20260713-1"
CORRECTIONS = {
    "Maori": "Māori",
    "maori": "Māori",
    "hapu": "hapū",
    "Hapu": "Hapū",
    "whanau": "whānau",
    "Whanau": "Whānau",
}

ANALYSIS_LIMITATIONS = (
    "Topic and section tags are deterministic search hints, not editorial classifications.",
    "Māori markers trigger review and do not constitute language identification.",
    "Speaker labels are anonymous and must not be used for speaker identification.",
    "Sensitive-content signals only request review and must not trigger automatic restriction or removal.",
)
ENRICHMENT_LIMITATIONS = (
    "Language signals request review and are not language identification.",
    "Entity candidates are unresolved surface forms and are not identity claims.",
    "Summaries are extractive transcript citations and may reproduce transcription errors.",
)

EVALUATION_LIMITATIONS = (
    "Synthetic fixture scores do not estimate production accuracy.",
    "Pilot promotion remains blocked until the target is processed and manually reviewed.",
    "Acoustic, language, entity and duplicate-model claims require domain-specific reviewed labels.",
)
ENRICHMENT_GATE = "manual_review_required"

EVENT_STATES = ("discovered", "expanded", "downloaded", "processed", "archived", "rejected", "retry")
PENDING_STATES = ("discovered", "retry")
DISPOSITIONS = ("approved", "needs_correction", "rights_review", "no_action")
PERMITTED_USAGES = ("Use commercially", "Share", "Modify")

MEDIA_EXTENSIONS = (".mp3", ".m4a", ".mp4", ".ogg", ".oga", ".wav", ".flac")
MEDIA_META_PROPERTIES = ("og:audio", "og:audio:url", "twitter:player:stream")
QUEUE_MEDIA_TAG = "rnz-queue-media"
CHILD_ID_INFIX = "--rnz-"
AUDIO_CONTENT_TYPES = (
    "audio/mpeg", "audio/mp4", "audio/ogg", "audio/wav", "audio/x-wav", "audio/flac", "video/mp4",
)

REQUIRED_ITEM_FILES = (
    "audio.flac", "transcript.json", "transcript.srt", "transcript.vtt", "transcript.txt",
    "diarization.rttm", "analysis.json", "chapters.json", "review.json", "audio-quality.json",
    "enrichment.json",
)

PAGE_SIZE = 20
MAX_PAGE_SIZE = 100
FACET_PAGE_SIZE = 10
MAX_FACET_PAGE_SIZE = 350
HARVEST_YEARS = 150
REPORT_ROWS = 25
MAX_ITEMS_PER_RUN = 5
PILOT_SIZE = 100
MAX_DURATION_SECONDS = 21_600
MAX_RETRIES = 3
REASON_CHARS = 500
NOTE_CHARS = 1000
CHAPTER_GAP_SECONDS = 5.0
CHAPTER_TITLE_CHARS = 120
SUMMARY_CHARS = 280
FUZZY_THRESHOLD = 0.55
PHONETIC_SCORE = 0.9
FUZZY_LIMIT = 20
SIMILARITY_THRESHOLD = 0.92
SAMPLE_RATE = 16_000
SILENCE_RMS = 32
CLIPPED_LEVEL = 32_760
FULL_SCALE = 32_768

# Path part before the number of an audio page, and the entry of its URL.
AUDIO_PART = "audio"
AUDIO_ENTRY = "audioSrc"

# Outcomes of pages without media, by the rule that applied.
ASSET_FAILURES = {
    "not_allowed": "source host is not allowlisted",
    "embedded_list": "landing page does not contain media for the requested audio ID",
    "first_link": "no allowlisted media URL found",
}

# Review reason of an item with a similar earlier one.
SIMILARITY_REASON = "activity_similarity_candidate"
