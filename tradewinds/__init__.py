"""Spark-native trade-flow analytics: lazy DataFrame plans over keyed observation tables."""
