"""matchlore: Spark jobs that turn match/event tables into question-answering data.

Every public function takes DataFrames and returns a DataFrame; see the README
for the map from task to module.
"""
