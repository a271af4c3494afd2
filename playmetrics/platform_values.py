"""The accepted client platforms."""

PLATFORMS = ["ANDROID", "IOS"]
