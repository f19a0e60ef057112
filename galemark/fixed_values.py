"""Topic names, thresholds, labels and vocabularies.

Results depend on these exact values, so they are kept together and in plain text.
"""

# Message topics.
WEATHER_TOPIC = "weather_raw"
AIR_TOPIC = "air_raw"
AIR_DAILY_TOPIC = "air_daily"
VIDEO_TOPIC = "youtube_raw"
SENTIMENT_TOPIC = "sentiment_scored"
POSTS_TOPIC = "reddit_posts"
COMMENTS_TOPIC = "reddit_comments"
SHORT_POST_TOPIC = "social_posts_raw"
CORE_TOPICS = (WEATHER_TOPIC, AIR_TOPIC, VIDEO_TOPIC, SENTIMENT_TOPIC)
ALL_TOPICS = (POSTS_TOPIC, COMMENTS_TOPIC, VIDEO_TOPIC, WEATHER_TOPIC, AIR_TOPIC, SENTIMENT_TOPIC)

# How late an event may be.
LATENESS = "2 days"

# The default place.
CITY = "boston"
REGION = "massachusetts"
COUNTRY = "usa"
LATITUDE = 42.3601
LONGITUDE = -71.0589
RADIUS_KM = 25.0
NEAREST_SENSORS = 5

# Wind classes, (exclusive upper bound, class); anything else is the last class.
WIND_BANDS = (
    (1, "Calm"),
    (2, "Light"),
    (5, "Gentle"),
    (8, "Moderate"),
    (11, "Fresh"),
    (14, "Strong"),
    (17, "Gale"),
)
WIND_ABOVE = "Storm"

# Anomaly limits and labels, first match wins.
HIGH_WIND = 14
HEAVY_PRECIPITATION = 50
HOT = 35
COLD = -15
ANOMALY_WIND = "High wind anomaly"
ANOMALY_PRECIPITATION = "Heavy precipitation anomaly"
ANOMALY_TEMPERATURE = "Extreme temperature anomaly"
NORMAL = "Normal"

# Air-quality classes in rising order; the position is the health risk level.
AIR_CLASSES = (
    "Good",
    "Moderate",
    "Unhealthy for Sensitive Groups",
    "Unhealthy",
    "Very Unhealthy",
)
NOT_CLASSIFIED = "Not Classified"

# Inclusive upper bounds of the first four classes per pollutant.
AIR_BOUNDS = {
    "pm25": (12, 35.4, 55.4, 150.4),
    "pm10": (50, 150, 250, 350),
    "o3": (54, 70, 85, 105),
}
SPIKE_ABOVE = 100

# Fixed values (ours): index at each class's upper bound, after the public US EPA index, and the
# concentration at which the open last class reaches 300.
INDEX_STEPS = (50, 100, 150, 200, 300)
INDEX_TOPS = {"pm25": 250.4, "pm10": 424, "o3": 200}

# Weight of an upvote in the engagement score.
UPVOTE_WEIGHT = 0.8

# Sentiment labels and their display text.
SENTIMENTS = ("positive", "negative", "neutral")
LABEL_TEXT = {
    "Positive": "✅ Positive",
    "Negative": "❌ Negative",
    "Neutral": "➖ Neutral",
}

# Topic phrases looked for in posts.
SEARCH_TERMS = (
    "climate change",
    "global warming",
    "air pollution",
    "heat wave",
    "environment",
)

# Fixed values (ours): places looked for in posts, Boston neighbourhoods.
PLACES = (
    "Allston",
    "Back Bay",
    "Beacon Hill",
    "Brighton",
    "Charlestown",
    "Chinatown",
    "Dorchester",
    "Downtown",
    "East Boston",
    "Fenway",
    "Hyde Park",
    "Jamaica Plain",
    "Mattapan",
    "Mission Hill",
    "North End",
    "Roslindale",
    "Roxbury",
    "South Boston",
    "South End",
    "West End",
    "West Roxbury",
)

# Components whose log records the pipeline panel shows.
LOG_COMPONENTS = ("weather_ingest", "air_ingest", "youtube_ingest", "spark_processor")

# Confidence bands in percent, (inclusive lower bound, colour).
CONFIDENCE_BANDS = ((75, "green"), (50, "yellow"))
CONFIDENCE_BELOW = "red"

# Fixed values (ours): bands of the absolute correlation, inclusive lower bound.
STRONG_CORRELATION = 0.7
MODERATE_CORRELATION = 0.4
