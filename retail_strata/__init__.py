"""Layered retail analytics on Spark: raw files -> bronze -> silver -> gold.

Every transformation is a ``DataFrame -> DataFrame`` function; reading,
writing, marks and stamps live at the edges (``sources``, ``plans``,
``streaming``).  The library never changes a session setting.
"""
