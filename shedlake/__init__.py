"""shedlake: a Spark-native sensor lakehouse for poultry-shed telemetry.

Every operator is a plain ``DataFrame -> DataFrame`` function; the streaming
modules only decide when those functions run and where their result is stored.
"""
