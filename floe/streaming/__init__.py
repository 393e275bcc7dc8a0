"""Work that recurs as the archive grows.

There is no event stream, watermark or state here: new scenes are picked up by
comparing candidates with what is already published, in batch.
"""
