"""cadenza: a Spark-native lyric-corpus engine (cleaning, training sets, n-gram models, songs, requests)."""
__version__ = "0.1.0"
