"""Word lists, lookup tables and constants used as dimensions.

Everything here is a fixed value: results depend on these exact entries.  Any
of them can be replaced by the caller (each operator takes its list, dict or
DataFrame as an argument); the larger ones (city gazetteer, sentiment lexicon,
spelling dictionary) are meant to be replaced by tables.
"""

from __future__ import annotations

# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# The common English stop list (179 words).
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Contraction rules in the order they apply, (pattern, expansion).
# Patterns are whole words; \1 is the part kept.
CONTRACTIONS = [
    ("(can)'t", r"\1not"),
    ("won't", "will not"),
    ("shan't", "shall not"),
    ("ain't", "are not"),
    ("let's", "let us"),
    ("y'all", "you all"),
    ("o'clock", "of the clock"),
    ("'cause", "because"),
    ("gonna", "going to"),
    ("gotta", "got to"),
    ("wanna", "want to"),
    ("(are|could|did|does|do|had|has|have|is|might|must|need|should|was|were|would)n't",
     r"\1 not"),
    ("(i)'m", r"\1 am"),
    ("(you|we|they|who|what|there)'re", r"\1 are"),
    ("(i|you|we|they|who|could|should|would|might|must|not)'ve", r"\1 have"),
    ("(i|you|he|she|it|we|they|that|there|who|what)'ll", r"\1 will"),
    ("(i|you|he|she|it|we|they|that|there|who|what)'d", r"\1 would"),
    ("(he|she|it|that|there|here|who|what|where|when|how|why)'s", r"\1 is"),
]

# Every contraction above contains one of these.
CONTRACTION_HINTS = ["'", "gonna", "gotta", "wanna"]

# US state codes and names (50 states and DC).
STATES = {
    "AK": "Alaska", "AL": "Alabama", "AR": "Arkansas", "AZ": "Arizona",
    "CA": "California", "CO": "Colorado", "CT": "Connecticut",
    "DC": "District of Columbia", "DE": "Delaware", "FL": "Florida",
    "GA": "Georgia", "HI": "Hawaii", "IA": "Iowa", "ID": "Idaho",
    "IL": "Illinois", "IN": "Indiana", "KS": "Kansas", "KY": "Kentucky",
    "LA": "Louisiana", "MA": "Massachusetts", "MD": "Maryland", "ME": "Maine",
    "MI": "Michigan", "MN": "Minnesota", "MO": "Missouri", "MS": "Mississippi",
    "MT": "Montana", "NC": "North Carolina", "ND": "North Dakota",
    "NE": "Nebraska", "NH": "New Hampshire", "NJ": "New Jersey",
    "NM": "New Mexico", "NV": "Nevada", "NY": "New York", "OH": "Ohio",
    "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania",
    "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota",
    "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VA": "Virginia",
    "VT": "Vermont", "WA": "Washington", "WI": "Wisconsin",
    "WV": "West Virginia", "WY": "Wyoming",
}

# A starter gazetteer of one-word US cities.  The full gazetteer
# is a parameter: pass any DataFrame with a `name` column.
CITIES = """
Aberdeen Abilene Akron Albany Albuquerque Alexandria Allentown Amarillo Anaheim
Anchorage Antioch Arlington Arvada Asheville Athens Atlanta Augusta Aurora Austin
Bakersfield Baltimore Beaumont Bellevue Berkeley Billings Birmingham Bloomington
Boise Boston Boulder Bridgeport Brockton Brownsville Buffalo Burbank Cambridge
Carlsbad Carrollton Cary Chandler Charleston Charlotte Chattanooga Chesapeake
Chicago Cincinnati Clarksville Clearwater Cleveland Columbia Columbus Concord
Corona Dallas Davenport Dayton Denton Denver Detroit Duluth Durham Elgin
Elizabeth Erie Escondido Eugene Evansville Everett Fairfield Fargo Fayetteville
Flint Fontana Fremont Fresno Frisco Fullerton Gainesville Garland Gilbert
Glendale Greensboro Greenville Hampton Hartford Hayward Henderson Hialeah
Hollywood Honolulu Houston Huntsville Independence Indianapolis Inglewood Irvine
Irving Jackson Jacksonville Joliet Killeen Knoxville Lafayette Lakeland Lakewood
Lancaster Lansing Laredo Lewisville Lexington Lincoln Louisville Lowell Lubbock
Macon Madison Manchester McAllen McKinney Memphis Mesa Mesquite Miami Midland
Milwaukee Minneapolis Miramar Mobile Modesto Montgomery Murfreesboro Naperville
Nashville Newark Norfolk Norman Oakland Oceanside Odessa Omaha Ontario Orange
Orlando Oxnard Palmdale Pasadena Paterson Peoria Philadelphia Phoenix Pittsburgh
Plano Pomona Portland Providence Provo Pueblo Raleigh Reno Richardson Richmond
Riverside Rochester Rockford Roseville Sacramento Salem Salinas Savannah
Scottsdale Seattle Shreveport Spokane Springfield Stamford Stockton Sunnyvale
Syracuse Tacoma Tallahassee Tampa Temecula Tempe Toledo Topeka Torrance Tucson
Tulsa Vallejo Ventura Visalia Waco Warren Waterbury Wichita Wilmington Worcester
Yonkers
""".split()

# The 25 health conditions counted per volume.
CONDITIONS = [
    "Heart disease", "Cancer", "Stroke", "Respiratory diseases",
    "Alzheimer's disease", "Diabetes", "Influenza and Pneumonia",
    "Kidney diseases", "Septicemia", "Liver disease", "Hypertension",
    "Parkinson's disease", "Chronic lower respiratory disease",
    "Accidents/injuries", "Osteoporosis", "Asthma", "Depression",
    "Oral health issues", "HIV/AIDS", "Tuberculosis", "Malaria",
    "Dengue fever", "Hepatitis", "Epilepsy", "Multiple sclerosis",
]

# The literals counted for a condition (in any case, without word
# boundaries) where they are not the condition's own name.
CONDITION_LITERALS = {
    "Respiratory diseases": ["Respiratory disease"],
    "Influenza and Pneumonia": ["Influenza", "Pneumonia"],
    "Kidney diseases": ["Kidney disease"],
    "Accidents/injuries": ["Accidents", "injuries"],
    "Dengue fever": ["Dengue"],
}

# News categories by group; categories not listed keep their name.
CATEGORY_GROUPS = {
    "LIFESTYLE": ["WELLNESS", "HEALTHY LIVING", "HOME & LIVING", "STYLE & BEAUTY", "STYLE"],
    "PARENTING": ["PARENTING", "PARENTS"],
    "EDUCATION": ["EDUCATION", "COLLEGE"],
    "ENTERTAINMENT": ["SPORTS", "ENTERTAINMENT", "COMEDY", "WEIRD NEWS", "ARTS"],
    "TRAVEL & CULTURE": ["TRAVEL", "ARTS & CULTURE", "CULTURE & ARTS", "FOOD & DRINK", "TASTE"],
    "SUPPORT & WELFARE": ["WOMEN", "QUEER VOICES", "LATINO VOICES", "BLACK VOICES"],
    "BUSINESS": ["BUSINESS", "MONEY"],
    "WORLDNEWS": ["THE WORLDPOST", "WORLDPOST", "WORLD NEWS"],
    "ENVIRONMENT": ["ENVIRONMENT", "GREEN"],
    "TECHNOLOGY": ["TECH", "SCIENCE"],
    "GENERAL": ["FIFTY", "IMPACT", "GOOD NEWS", "CRIME"],
    "OTHER": ["WEDDINGS", "DIVORCE", "RELIGION", "MEDIA"],
}

# A starter sentiment lexicon, (word, valence -4..4,
# polarity -1..1, subjectivity 0..1).  Pass any DataFrame with these columns.
LEXICON = [
    ("amazing", 2.8, 0.6, 0.9), ("awesome", 3.1, 1.0, 1.0),
    ("awful", -2.0, -1.0, 1.0), ("bad", -2.5, -0.7, 0.67),
    ("best", 3.2, 1.0, 0.3), ("better", 1.9, 0.5, 0.5),
    ("broken", -2.1, -0.4, 0.4), ("cheap", -0.6, 0.4, 0.7),
    ("comfortable", 2.3, 0.4, 0.8), ("defective", -1.9, -0.5, 0.6),
    ("disappointed", -1.9, -0.75, 0.75), ("easy", 1.9, 0.43, 0.83),
    ("enjoy", 2.2, 0.4, 0.5), ("excellent", 2.7, 1.0, 1.0),
    ("fantastic", 2.6, 0.4, 0.9), ("fine", 0.8, 0.42, 0.5),
    ("good", 1.9, 0.7, 0.6), ("great", 3.1, 0.8, 0.75),
    ("happy", 2.7, 0.8, 1.0), ("hate", -2.7, -0.8, 0.9),
    ("horrible", -2.5, -1.0, 1.0), ("junk", -1.5, -0.3, 0.5),
    ("love", 3.2, 0.5, 0.6), ("nice", 1.8, 0.6, 1.0),
    ("perfect", 2.7, 1.0, 1.0), ("poor", -2.1, -0.4, 0.6),
    ("problem", -1.7, -0.2, 0.3), ("sad", -2.1, -0.5, 1.0),
    ("terrible", -2.1, -1.0, 1.0), ("useless", -1.8, -0.5, 0.2),
    ("waste", -1.8, -0.2, 0.0), ("wonderful", 2.7, 1.0, 1.0),
    ("worst", -3.1, -1.0, 1.0), ("wrong", -2.1, -0.5, 0.9),
]

# The lexicon scores' normalisation constant and class cuts.
COMPOUND_ALPHA = 15.0
COMPOUND_CUT = 0.05

# The columns of the entity table, in order.
ENTITY_COLUMNS = [
    "First_Name", "Last_Name", "Address", "Email", "Phone_1", "Phone_2",
    "City", "County", "State", "Company name",
]


def category_map() -> dict[str, str]:
    """category -> group name."""
    return {c: g for g, cs in CATEGORY_GROUPS.items() for c in cs}
